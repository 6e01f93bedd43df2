"""Parsing of raw topic records and validation of requests and rule specs.

Inputs are raw records (``topic, partition, offset, key, value, ingest_ts``). A missing event time
falls back to ``ingest_ts``, never to the wall clock, so a replay gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsonfields as J
from ..functions.columns import MONEY, instant, is_uuid, millis
from ..sources.schemas import DEFAULT_BASELINE_RISK, DEFAULT_RULE

_DOC = "_doc"
_PROVENANCE = ["topic", "partition", "offset", "key", "value", "ingest_ts"]


def _with_doc(records: DataFrame, texts: Sequence[str] = (), fields: Sequence[str] = ()) -> DataFrame:
    """Adds the parsed document and the text of each text field, once each: later expressions reuse them."""
    return J.with_document(records, "value", _DOC, fields, texts)


def _text(field: str) -> Column:
    return F.col(J.text_name(field))


def _first_error(*rules: tuple[Column, str]) -> Column:
    """Text of the first rule that is broken; NULL when none is."""
    chain = None
    for broken, message in rules:
        chain = F.when(broken, message) if chain is None else chain.when(broken, message)
    return chain


def _missing(field: str) -> tuple[Column, str]:
    return _text(field).isNull(), f"missing or blank field: {field}"


def parse_payments(records: DataFrame) -> DataFrame:
    """Payments with an ``error`` column; good rows have it NULL. Amounts are doubles here."""
    doc = F.col(_DOC)
    error = _first_error(
        (J.is_not_json(doc), "invalid json"),
        _missing("eventId"),
        _missing("paymentId"),
        _missing("accountId"),
        (~J.present(doc, "amount"), "missing amount"),
    )
    at = F.coalesce(instant(_text("occurredAt")), millis("ingest_ts"))
    return _with_doc(records, ["eventId", "paymentId", "accountId", "currency", "merchantId", "occurredAt"], ["amount"]).select(
        *_PROVENANCE,
        error.alias("error"),
        _text("eventId").alias("event_id"),
        _text("paymentId").alias("payment_id"),
        _text("accountId").alias("account_id"),
        J.coerced_double(doc, "amount").alias("amount"),
        F.coalesce(_text("currency"), F.lit("UNKNOWN")).alias("currency"),
        _text("merchantId").alias("merchant_id"),
        at.alias("occurred_at"),
        F.unix_millis(at).alias("occurred_ms"),
    )


def valid_payments(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNull()).drop("error", "value")


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Rejected records with their whole text, so that they can be replayed; a display may cut it."""
    return parsed.filter(F.col("error").isNotNull()).select(
        F.col("value").alias("raw"), "error", F.col("ingest_ts").alias("occurred_at")
    )


def parse_payments_strict(records: DataFrame) -> DataFrame:
    """Ledger profile: currency, a UUID payment id and a valid event time are required as well."""
    doc = F.col(_DOC)
    amount = J.coerced_money(doc, "amount", MONEY)
    at = instant(_text("occurredAt"))
    error = _first_error(
        (J.is_not_json(doc), "invalid json"),
        _missing("eventId"),
        _missing("paymentId"),
        (~is_uuid(_text("paymentId")), "paymentId is not a UUID"),
        _missing("accountId"),
        _missing("currency"),
        (~J.present(doc, "amount"), "missing amount"),
        (amount.isNull(), "amount is not a number"),
        _missing("occurredAt"),
        (at.isNull(), "occurredAt is not an offset date-time"),
    )
    return _with_doc(records, ["eventId", "paymentId", "accountId", "currency", "occurredAt"], ["amount"]).select(
        *_PROVENANCE,
        error.alias("error"),
        _text("eventId").alias("event_id"),
        _text("paymentId").alias("payment_id"),
        _text("accountId").alias("account_id"),
        amount.alias("amount"),
        _text("currency").alias("currency"),
        at.alias("occurred_at"),
    )


def projection_dlt(strict: DataFrame) -> DataFrame:
    """Poison records for ``<topic>.DLT``, same partition. Parsing is deterministic, so no retry."""
    return strict.filter(F.col("error").isNotNull()).select(
        F.concat("topic", F.lit(".DLT")).alias("topic"), "partition", "offset", "key", "value", "error"
    )


def parse_live_payments(records: DataFrame) -> DataFrame:
    """Lenient profile of the live view: no amount is 0, malformed records are skipped."""
    doc = F.col(_DOC)
    amount = F.coalesce(J.coerced_money(doc, "amount", MONEY), F.lit(0).cast(MONEY))
    return (
        _with_doc(records, ["paymentId", "accountId", "currency", "merchantId", "sagaId", "occurredAt"], ["amount"])
        .filter(J.is_object(doc) & _text("paymentId").isNotNull() & _text("accountId").isNotNull())
        .select(
            "offset",
            _text("paymentId").alias("payment_id"),
            _text("accountId").alias("account_id"),
            amount.alias("amount"),
            F.coalesce(_text("currency"), F.lit("UNKNOWN")).alias("currency"),
            _text("merchantId").alias("merchant_id"),
            _text("sagaId").alias("saga_id"),
            F.coalesce(instant(_text("occurredAt")), millis("ingest_ts")).alias("occurred_at"),
        )
    )


def parse_saga_events(records: DataFrame) -> DataFrame:
    doc = F.col(_DOC)
    attempt = F.when(J.is_integer(doc, "attempt"), J.number(doc, "attempt", "int"))
    return (
        _with_doc(records, ["sagaId", "eventType", "stepName", "status", "paymentId", "occurredAt"], ["attempt"])
        .filter(_text("sagaId").isNotNull())
        .select(
            "offset",
            _text("sagaId").alias("saga_id"),
            F.coalesce(_text("eventType"), F.lit("SAGA_UPDATE")).alias("event_type"),
            _text("stepName").alias("step_name"),
            _text("status").alias("status"),
            _text("paymentId").alias("payment_id"),
            F.coalesce(attempt, F.lit(1)).alias("attempt"),
            F.coalesce(instant(_text("occurredAt")), millis("ingest_ts")).alias("occurred_at"),
        )
    )


def parse_alerts(records: DataFrame) -> DataFrame:
    """Alerts with epoch-millisecond or date-time event time; a bad date-time makes a record malformed."""
    doc = F.col(_DOC)
    from_text = _text("occurredAt")
    from_ms = F.timestamp_millis(J.number(doc, "occurredAtEpochMs", "long"))
    at = F.when(from_ms.isNotNull(), from_ms).when(from_text.isNotNull(), instant(from_text)).otherwise(millis("ingest_ts"))
    required = [_text(f).isNotNull() for f in ("alertId", "userId", "paymentId")]
    return (
        _with_doc(records, ["alertId", "userId", "paymentId", "ruleId", "occurredAt"], ["score", "reasons", "occurredAtEpochMs"])
        .filter(required[0] & required[1] & required[2] & at.isNotNull())
        .select(
            "offset",
            _text("alertId").alias("alert_id"),
            _text("userId").alias("user_id"),
            _text("paymentId").alias("payment_id"),
            F.coalesce(J.coerced_double(doc, "score"), F.lit(0.0)).alias("score"),
            J.text_items(doc, "reasons").alias("reasons"),
            F.coalesce(_text("ruleId"), F.lit("unknown")).alias("rule_id"),
            at.alias("occurred_at"),
        )
    )


def parse_rule_acks(records: DataFrame) -> DataFrame:
    """Applied rule versions. Tombstones are skipped; the record key stands in for a missing rule id."""
    doc = F.col(_DOC)
    own_id = F.when(J.kind(doc, "ruleId") == "STRING", J.value(doc, "ruleId", "string"))
    return (
        _with_doc(records, fields=["ruleId", "version"])
        .filter(J.is_object(doc))
        .select(
            "offset",
            F.coalesce(own_id, F.col("key")).alias("rule_id"),
            F.coalesce(J.number(doc, "version", "long"), F.lit(1).cast("long")).alias("version"),
        )
        .filter(F.col("rule_id").isNotNull())
    )


_RULE_JSON = [
    "ruleId",
    "version",
    "enabled",
    "maxAmount",
    "velocityWindowMs",
    "velocityMaxCount",
    "structuringThreshold",
    "structuringWindowHours",
    "structuringMinPayments",
]


def parse_rules(records: DataFrame) -> DataFrame:
    """Rules with a default per missing field; unknown fields are ignored."""
    doc, d = F.col(_DOC), DEFAULT_RULE

    def field(name: str, type_name: str, default) -> Column:
        return F.coalesce(J.value(doc, name, type_name), F.lit(default).cast(type_name))

    return (
        _with_doc(records, fields=_RULE_JSON)
        .filter(J.is_object(doc))
        .select(
            "offset",
            field("ruleId", "string", d.rule_id).alias("rule_id"),
            field("version", "long", d.version).alias("version"),
            field("enabled", "boolean", d.enabled).alias("enabled"),
            field("maxAmount", "double", d.max_amount).alias("max_amount"),
            field("velocityWindowMs", "long", d.velocity_window_ms).alias("velocity_window_ms"),
            field("velocityMaxCount", "long", d.velocity_max_count).alias("velocity_max_count"),
            field("structuringThreshold", "double", d.structuring_threshold).alias("structuring_threshold"),
            field("structuringWindowHours", "long", d.structuring_window_hours).alias("structuring_window_hours"),
            field("structuringMinPayments", "long", d.structuring_min_payments).alias("structuring_min_payments"),
        )
    )


def parse_profiles(records: DataFrame) -> DataFrame:
    doc = F.col(_DOC)
    risk = J.value(doc, "baselineRisk", "double")
    return (
        _with_doc(records, fields=["userId", "baselineRisk"])
        .select(
            "offset",
            J.value(doc, "userId", "string").alias("user_id"),
            F.coalesce(risk, F.lit(DEFAULT_BASELINE_RISK)).alias("baseline_risk"),
        )
        .filter(F.col("user_id").rlike(r"\S"))
    )


# Fields of a rule spec with type, lower and upper bound. No other field is allowed.
RULE_SPEC_FIELDS = (
    ("maxAmount", "number", 0, None),
    ("velocityWindowMs", "integer", 1000, None),
    ("velocityMaxCount", "integer", 1, None),
    ("structuringThreshold", "number", 0, None),
    ("structuringWindowHours", "integer", 1, 168),
    ("structuringMinPayments", "integer", 2, None),
)


def rule_spec_errors(specs: DataFrame, spec: str = "json_spec") -> DataFrame:
    """Adds ``errors``: every broken constraint of a rule spec, joined by ``; `` (empty when valid)."""
    doc = F.col(_DOC)
    names = F.json_object_keys(F.col(spec))
    checks, kinds = [], {}
    for name, type_name, low, high in RULE_SPEC_FIELDS:
        kinds[f"_k_{name}"] = J.kind(doc, name)
        kinds[f"_d_{name}"] = J.number(doc, name)
        kind, value = F.col(f"_k_{name}"), F.col(f"_d_{name}")
        right_type = value.isNotNull() & (value == F.floor(value)) if type_name == "integer" else value.isNotNull()
        checks.append(F.when(kind.isNull(), f"{name}: is required"))
        checks.append(
            F.when(kind.isNotNull() & ~right_type, f"{name}: must be {'an' if type_name == 'integer' else 'a'} {type_name}")
        )
        checks.append(F.when(right_type & (value < low), f"{name}: must be at least {low}"))
        if high is not None:
            checks.append(F.when(right_type & (value > high), f"{name}: must be at most {high}"))
    allowed = F.array(*[F.lit(f[0]) for f in RULE_SPEC_FIELDS])
    extra = F.transform(F.array_except(names, allowed), lambda n: F.concat(n, F.lit(": is not allowed")))
    found = F.concat(F.array_compact(F.array(*checks)), F.coalesce(extra, F.array().cast("array<string>")))
    text = (
        F.when(F.coalesce(J.is_not_json(doc), F.lit(True)), "json_spec is not valid JSON")
        .when(~J.is_object(doc), "json_spec is not an object")
        .otherwise(F.array_join(found, "; "))
    )
    looked_at = J.with_document(specs, spec, _DOC, [f[0] for f in RULE_SPEC_FIELDS]).withColumns(kinds)
    return looked_at.withColumn("errors", text).drop(_DOC, *kinds)


def payment_request_errors(requests: DataFrame) -> DataFrame:
    """Adds ``errors`` for a blank account or currency or an amount that is not positive."""
    found = F.array_compact(
        F.array(
            F.when(~F.coalesce(F.col("account_id").rlike(r"\S"), F.lit(False)), "accountId: must not be blank"),
            F.when(~F.coalesce(F.col("amount") > 0, F.lit(False)), "amount: must be greater than 0"),
            F.when(~F.coalesce(F.col("currency").rlike(r"\S"), F.lit(False)), "currency: must not be blank"),
        )
    )
    return requests.withColumn("errors", F.array_join(found, "; "))
