"""Landing of topics into raw tables, dedup, retention, routing and sink payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsonfields as J
from ..functions.columns import MONEY, time_or_zero
from ..functions.joins import first_per_key
from ..sources.topics import keyed_json

_DOC = "_doc"

# Days a raw table keeps; payments are kept for ever.
RETENTION_DAYS = {"fraud_alerts": 90, "payment_metrics_hourly": 180, "saga_events": 90}
# Sort keys of the raw tables. Rows with an equal key replace each other.
SORT_KEYS = {
    "payment_events": ["account_id", "occurred_at", "event_id"],
    "fraud_alerts": ["alert_date", "user_id", "alert_id"],
    "payment_metrics_hourly": ["metric_date", "currency", "window_start"],
    "saga_events": ["saga_id", "occurred_at", "event_type"],
}


def _with_doc(records: DataFrame, *fields: str) -> DataFrame:
    return J.with_document(records, "value", _DOC, fields)


def _text(field: str) -> Column:
    """Landing text: a missing field is the empty string, numbers become text."""
    return F.coalesce(J.value(F.col(_DOC), field, "string"), F.lit(""))


def _number(field: str, type_name: str) -> Column:
    return F.coalesce(J.value(F.col(_DOC), field, type_name), F.lit(0).cast(type_name))


def landing_error(number_fields: Sequence[str]) -> Column:
    """Reason why a record cannot be landed, NULL when it can. Missing fields are not an error."""
    doc = F.col(_DOC)
    error = F.when(F.coalesce(J.is_not_json(doc), F.lit(True)), "cannot parse input: not JSON").when(
        ~J.is_object(doc), "cannot parse input: not an object"
    )
    for field in number_fields:
        bad = J.present(doc, field) & J.value(doc, field, "double").isNull()
        error = error.when(bad, f"cannot parse number: {field}")
    return error


def read_payment_topic(records: DataFrame) -> DataFrame:
    """Payment records with provenance and ``error``; the good and the bad landing read from this."""
    doc = F.col(_DOC)
    amount = F.coalesce(J.coerced_money(doc, "amount", MONEY), F.lit(0).cast(MONEY))
    return _with_doc(records, "eventId", "paymentId", "accountId", "amount", "currency", "merchantId", "occurredAt").select(
        "topic",
        "partition",
        "offset",
        F.col("value").alias("raw_message"),
        "ingest_ts",
        landing_error(["amount"]).alias("error"),
        _text("eventId").alias("event_id"),
        _text("paymentId").alias("payment_id"),
        _text("accountId").alias("account_id"),
        amount.alias("amount"),
        _text("currency").alias("currency"),
        J.value(doc, "merchantId", "string").alias("merchant_id"),
        time_or_zero(_text("occurredAt")).alias("occurred_at"),
    )


def land_payments(read: DataFrame) -> DataFrame:
    return read.filter(F.col("error").isNull()).drop("error", "raw_message", "ingest_ts", "topic", "partition")


def topic_dlq(read: DataFrame) -> DataFrame:
    """The records of a read topic that cannot be landed, with their place and text."""
    return read.filter(F.col("error").isNotNull()).select(
        "topic", "partition", "offset", "raw_message", "error", F.col("ingest_ts").alias("ingested_at")
    )


payment_dlq = topic_dlq



def _place() -> list:
    return ["topic", "partition", "offset", F.col("value").alias("raw_message"), "ingest_ts"]


def landed(read: DataFrame) -> DataFrame:
    """The good rows of a read topic, without what only rejects need."""
    return read.filter(F.col("error").isNull()).drop("error", "raw_message", "ingest_ts", "topic", "partition")


def read_alert_topic(records: DataFrame) -> DataFrame:
    doc = F.col(_DOC)
    at = F.timestamp_millis(_number("occurredAtEpochMs", "long"))
    return (
        _with_doc(records, "alertId", "userId", "paymentId", "score", "reasons", "ruleId", "occurredAtEpochMs")
        .select(
            *_place(),
            landing_error(["score", "occurredAtEpochMs"]).alias("error"),
            _text("alertId").alias("alert_id"),
            _text("userId").alias("user_id"),
            _text("paymentId").alias("payment_id"),
            _number("score", "double").alias("score"),
            J.text_items(doc, "reasons").alias("reasons"),
            _text("ruleId").alias("rule_id"),
            F.to_date(at).alias("alert_date"),
            at.alias("occurred_at"),
        )
    )


def read_metric_topic(records: DataFrame) -> DataFrame:
    start = F.timestamp_millis(_number("windowStartEpochMs", "long"))
    return (
        _with_doc(records, "windowStartEpochMs", "windowEndEpochMs", "currency", "count", "totalAmount")
        .select(
            *_place(),
            landing_error(["windowStartEpochMs", "windowEndEpochMs", "count", "totalAmount"]).alias("error"),
            start.alias("window_start"),
            F.timestamp_millis(_number("windowEndEpochMs", "long")).alias("window_end"),
            F.to_date(start).alias("metric_date"),
            _text("currency").alias("currency"),
            _number("count", "long").alias("payment_count"),
            _number("totalAmount", "double").alias("total_amount"),
        )
    )


def read_saga_topic(records: DataFrame) -> DataFrame:
    doc = F.col(_DOC)
    at = time_or_zero(_text("occurredAt"))
    return (
        _with_doc(records, "sagaId", "sagaType", "eventType", "status", "stepName", "paymentId", "attempt", "occurredAt")
        .select(
            *_place(),
            landing_error(["attempt"]).alias("error"),
            _text("sagaId").alias("saga_id"),
            _text("sagaType").alias("saga_type"),
            _text("eventType").alias("event_type"),
            _text("status").alias("status"),
            J.value(doc, "stepName", "string").alias("step_name"),
            J.value(doc, "paymentId", "string").alias("payment_id"),
            _number("attempt", "int").alias("attempt"),
            F.to_date(at).alias("event_date"),
            at.alias("occurred_at"),
        )
    )


def land_alerts(records: DataFrame) -> DataFrame:
    return landed(read_alert_topic(records))


def land_metrics(records: DataFrame) -> DataFrame:
    return landed(read_metric_topic(records))


def land_saga_events(records: DataFrame) -> DataFrame:
    return landed(read_saga_topic(records))


# Reader of the topic behind each raw table, and the column that gives a row's month.
TOPIC_READERS = {
    "payment_events": (read_payment_topic, "occurred_at"),
    "fraud_alerts": (read_alert_topic, "alert_date"),
    "payment_metrics_hourly": (read_metric_topic, "metric_date"),
    "saga_events": (read_saga_topic, "event_date"),
}


def dedup_replacing(df: DataFrame, keys: Sequence[str], version: str = "offset") -> DataFrame:
    """Last write wins per sort key."""
    return first_per_key(df, keys, F.col(version).desc())


def dedup_first(df: DataFrame, keys: Sequence[str], arrival: str = "arrival") -> DataFrame:
    """First write wins per key."""
    return first_per_key(df, keys, F.col(arrival).asc())


def retention_apply(df: DataFrame, date_column: str, days: int, as_of: Column) -> DataFrame:
    """Rows not yet expired; on month-partitioned tables pair it with a filter on ``month`` to prune."""
    return df.filter(F.date_add(F.col(date_column), days) > F.to_date(as_of))


def cdc_route(changes: DataFrame) -> DataFrame:
    """Routes change rows (``source, id, key, type, payload`` and header columns) to topics.

    Each source table has its own rule: event-store rows all go to one topic; outbox rows are renamed
    only when their type matches, otherwise the type itself is the topic.
    """
    # Source table, type pattern and topic.
    topic = (
        F.when(F.col("source") == "event_store", "payment.events")
        .when((F.col("source") == "outbox") & (F.col("type") == "SagaStart:PaymentSaga"), "saga.commands.start")
        .when((F.col("source") == "rule_outbox") & (F.col("type") == "FraudRuleUpdated"), "fraud_rules")
        .otherwise(F.col("type"))
    )
    headers = F.when(
        F.col("source") == "event_store",
        F.to_json(
            F.struct(
                F.col("type").alias("eventType"),
                F.col("version").alias("eventVersion"),
                F.col("aggregate_id").alias("aggregateId"),
            )
        ),
    )
    return changes.filter(F.col("payload").isNotNull()).select(
        topic.alias("topic"), "id", "key", headers.alias("headers"), F.col("payload").alias("value")
    )


def alert_records(alerts: DataFrame) -> DataFrame:
    value = F.struct(
        F.col("alert_id").alias("alertId"),
        F.col("user_id").alias("userId"),
        F.col("payment_id").alias("paymentId"),
        "score",
        "reasons",
        F.col("rule_id").alias("ruleId"),
        F.col("occurred_ms").alias("occurredAtEpochMs"),
    )
    return keyed_json(alerts, F.col("user_id"), value)


def score_records(scores: DataFrame) -> DataFrame:
    value = F.struct(
        F.col("user_id").alias("userId"),
        "score",
        F.col("last_payment_id").alias("lastPaymentId"),
        F.col("updated_at").alias("updatedAtEpochMs"),
    )
    return keyed_json(scores, F.col("user_id"), value)


def metric_records(metrics: DataFrame) -> DataFrame:
    start, end = F.unix_millis("window_start"), F.unix_millis("window_end")
    value = F.struct(
        start.alias("windowStartEpochMs"),
        end.alias("windowEndEpochMs"),
        "currency",
        F.col("payment_count").alias("count"),
        F.col("total_amount").cast("double").alias("totalAmount"),
    )
    return keyed_json(metrics, F.concat_ws(":", start.cast("string"), "currency"), value)


def dead_letter_records(letters: DataFrame) -> DataFrame:
    value = F.struct("raw", "error", F.unix_millis("occurred_at").alias("occurredAtEpochMs"))
    return keyed_json(letters, None, value)
