"""Parsing, landing, rules and fraud detection."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import literal_time, money, time_or_zero
from ..operators import fraud as D
from ..operators import landing as L
from ..operators import monitoring as M
from ..operators import parsing as P
from ..operators import rules as R
from ..operators import serving as V
from ..sources import samples as S
from ..sources.tables import read_table
from .base import REASONS, SCORE, query

AS_OF = S.AS_OF
_GOOD = "k%10 NOT IN (3,7)"


def records(df, value, key=None, offset="seq", topic="topic"):
    """Raw topic records around a JSON value."""
    return df.select(
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col(offset).cast("long").alias("offset"),
        (key if key is not None else F.lit(None)).cast("string").alias("key"),
        value.alias("value"),
        literal_time(AS_OF).alias("ingest_ts"),
    )


# Parsing


@query(
    "parse_payments",
    f"""SELECT event_id, payment_id, account_id, CAST(amount AS DOUBLE) AS amount, currency, nullif(merchant_id,'') AS merchant_id,
      occurred_at, occurred_ms FROM raw WHERE {_GOOD}""",
)
def _(spark, folder):
    good = P.valid_payments(P.parse_payments(S.raw_payments(spark, folder)))
    return good.select(
        "event_id", "payment_id", "account_id", "amount", "currency", "merchant_id", "occurred_at", "occurred_ms"
    )


@query(
    "dead_letter",
    f"""SELECT value AS raw, CASE WHEN k%10=3 THEN 'invalid json' ELSE 'missing or blank field: accountId' END AS error,
      TIMESTAMP '{AS_OF}' AS occurred_at FROM raw WHERE NOT ({_GOOD})""",
)
def _(spark, folder):
    return P.dead_letters(P.parse_payments(S.raw_payments(spark, folder)))


def _strict_records(spark, folder):
    """Raw payments whose payment id is a UUID except where ``seq % 6`` is 0."""
    raw = S.raw_payments(spark, folder)
    digits = F.lpad(F.col("offset").cast("string"), 12, "0")
    uuid = F.concat(F.lit("00000000-0000-4000-8000-"), digits)
    plain = F.concat(F.lit("pay-"), F.col("offset").cast("string"))
    fixed = F.when(F.col("offset") % 6 != 0, F.replace("value", plain, uuid)).otherwise(F.col("value"))
    return raw.withColumn("value", fixed)


@query(
    "parse_payments_strict",
    f"""SELECT event_id, '00000000-0000-4000-8000-'||lpad(CAST(seq AS VARCHAR),12,'0') AS payment_id, account_id,
      CAST(amount AS DOUBLE) AS amount, currency, occurred_at FROM raw WHERE {_GOOD} AND seq%6<>0""",
)
def _(spark, folder):
    strict = P.parse_payments_strict(_strict_records(spark, folder)).filter(F.col("error").isNull())
    return strict.select("event_id", "payment_id", "account_id", "amount", "currency", "occurred_at")


@query(
    "projection_dlt",
    f"""SELECT 'payment.events.DLT' AS topic, CAST(seq%3 AS INT) AS "partition", seq AS "offset", account_id AS "key",
      CASE WHEN k%10=3 THEN 'invalid json' WHEN seq%6=0 THEN 'paymentId is not a UUID' ELSE 'missing or blank field: accountId' END AS error,
      CASE WHEN k%10=3 OR seq%6=0 THEN value ELSE replace(value, 'pay-'||seq, '00000000-0000-4000-8000-'||lpad(CAST(seq AS VARCHAR),12,'0')) END AS value
    FROM raw WHERE NOT ({_GOOD}) OR seq%6=0""",
)
def _(spark, folder):
    return P.projection_dlt(P.parse_payments_strict(_strict_records(spark, folder)))


@query(
    "parse_live_payments",
    f"""SELECT payment_id, account_id, CAST(amount AS DOUBLE) AS amount, currency, nullif(merchant_id,'') AS merchant_id, occurred_at
    FROM raw WHERE {_GOOD}""",
)
def _(spark, folder):
    return P.parse_live_payments(S.raw_payments(spark, folder)).drop("offset", "saga_id")


def _saga_records(spark, folder):
    """JSON lifecycle events; some lack the type, the attempt or the saga id."""
    e = S.saga_events(spark, folder)
    key = F.regexp_replace("saga_id", "saga-", "").cast("long")
    value = F.to_json(
        F.struct(
            F.when(key % 11 != 0, F.col("saga_id")).alias("sagaId"),
            F.col("saga_type").alias("sagaType"),
            F.when(key % 5 != 0, F.col("event_type")).alias("eventType"),
            "status",
            F.col("step_name").alias("stepName"),
            F.col("payment_id").alias("paymentId"),
            F.when(key % 3 != 0, F.col("attempt")).alias("attempt"),
            F.date_format("occurred_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("occurredAt"),
        )
    )
    return records(e, value, F.col("saga_id"))


@query(
    "parse_saga_events",
    """SELECT saga_id, CASE WHEN n%5<>0 THEN event_type ELSE 'SAGA_UPDATE' END AS event_type, step_name, status, payment_id,
      CAST(CASE WHEN n%3<>0 THEN attempt ELSE 1 END AS INT) AS attempt, occurred_at
    FROM (SELECT *, seq//10 AS n FROM sev) WHERE n%11<>0""",
)
def _(spark, folder):
    return P.parse_saga_events(_saga_records(spark, folder)).drop("offset")


def _alert_records(spark, folder):
    """JSON alerts: a mixed reasons array, and either form of event time."""
    a = S.alerts_raw(spark, folder)
    reasons = F.concat(F.lit('["'), F.array_join("reasons", '",7,"'), F.lit('"]'))
    at = F.date_format("occurred_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    time = F.when(
        F.col("seq") % 2 == 0, F.concat(F.lit('"occurredAtEpochMs":'), F.col("occurred_ms").cast("string"))
    ).otherwise(F.concat(F.lit('"occurredAt":"'), at, F.lit('"')))
    value = F.concat(
        F.lit('{"alertId":"'), "alert_id", F.lit('","userId":"'), "user_id", F.lit('","paymentId":"'), "payment_id",
        F.lit('","score":'), F.col("score").cast("string"), F.lit(',"reasons":'), reasons,
        F.lit(',"ruleId":"'), "rule_id", F.lit('",'), time, F.lit("}"),
    )
    return records(a, value, F.col("user_id"))


@query(
    "parse_alerts",
    "SELECT alert_id, user_id, payment_id, score, reasons, coalesce(nullif(rule_id,''),'unknown') AS rule_id, occurred_at FROM al",
)
def _(spark, folder):
    return P.parse_alerts(_alert_records(spark, folder)).drop("offset")


def _rule_changes(spark, folder):
    """Change log of rules, one rule per customer with up to three changes."""
    c = read_table(spark, folder, "customer")
    key = F.col("c_custkey")
    item = lambda i, action: F.struct(F.lit(i).alias("i"), F.lit(action).alias("action"))
    entries = F.array_compact(
        F.array(
            item(0, "create"),
            F.when(key % 2 == 0, item(1, "update")),
            F.when(key % 6 == 0, item(2, "update")),
            F.when(key % 5 == 0, item(3, "delete")),
        )
    )
    text = lambda c: c.cast("string")
    spec = F.concat(
        F.lit('{"maxAmount":'), text(F.round(F.col("c_acctbal")).cast("long")),
        F.lit(',"velocityWindowMs":'), text(key % 50 * 100), F.lit(',"velocityMaxCount":'), text(key % 9),
        F.lit(',"structuringThreshold":9900,"structuringWindowHours":'), text(key % 200),
        F.when(key % 10 == 3, "").otherwise(F.lit(',"structuringMinPayments":3')),
        F.when(key % 10 == 4, F.lit(',"bogus":1}')).otherwise("}"),
    )
    return c.withColumn("_e", F.explode(entries)).select(
        F.concat(F.lit("rule-"), key).alias("id"),
        F.concat(F.col("c_name"), F.lit("/"), text(F.col("_e.i"))).alias("name"),
        (key % 3 != 0).alias("enabled"),
        F.when(key % 10 == 7, "{not json").otherwise(spec).alias("json_spec"),
        F.col("_e.action").alias("action"),
        (key * 10 + F.col("_e.i")).alias("seq"),
        F.timestamp_seconds(F.lit(1_704_067_200) + key * 10 + F.col("_e.i")).alias("changed_at"),
    )


_CHANGES = """
  SELECT 'rule-'||c_custkey AS id, c_name||'/'||i AS name, c_custkey%3<>0 AS enabled, action, c_custkey*10+i AS seq, c_custkey AS n,
    TIMESTAMP '2024-01-01' + to_seconds(c_custkey*10+i) AS changed_at, c_acctbal,
    sum(CASE WHEN action='delete' THEN 0 ELSE 1 END) OVER (PARTITION BY c_custkey ORDER BY i) AS version,
    row_number() OVER (PARTITION BY c_custkey ORDER BY i DESC) AS rn
  FROM customer, (VALUES (0,'create'),(1,'update'),(2,'update'),(3,'delete')) e(i,action)
  WHERE i=0 OR (i=1 AND c_custkey%2=0) OR (i=2 AND c_custkey%6=0) OR (i=3 AND c_custkey%5=0)"""


def _ack_records(spark, folder):
    """Published rule records: some are tombstones, some have no id or no version."""
    v = R.rule_versions(_rule_changes(spark, folder))
    key = F.floor(F.col("seq") / 10)
    body = F.to_json(
        F.struct(
            F.when(key % 4 != 0, F.col("id")).alias("ruleId"), F.when(key % 7 != 0, F.col("version")).alias("version"), "enabled"
        )
    )
    return records(v, F.when(F.col("action") != "delete", body), F.col("id"))


_ACKS = f"SELECT id AS rule_id, CAST(CASE WHEN n%7<>0 THEN version ELSE 1 END AS BIGINT) AS version FROM ({_CHANGES}) WHERE action<>'delete'"


@query("parse_rule_acks", _ACKS)
def _(spark, folder):
    return P.parse_rule_acks(_ack_records(spark, folder)).drop("offset")


@query("rule_latest_version", f"SELECT rule_id, max(version) AS version FROM ({_ACKS}) GROUP BY 1")
def _(spark, folder):
    return R.rule_latest_version(P.parse_rule_acks(_ack_records(spark, folder)))


@query(
    "rule_acks_since",
    f"""SELECT rule_id, version, false AS already_applied FROM ({_ACKS}) WHERE version>=2 AND rule_id='rule-12'
    UNION ALL SELECT rule_id, max(version), true FROM ({_ACKS}) WHERE rule_id='rule-12' GROUP BY 1 HAVING max(version)>=2""",
)
def _(spark, folder):
    return R.rule_acks_since(P.parse_rule_acks(_ack_records(spark, folder)), "rule-12", 2)


@query(
    "parse_rules",
    f"""SELECT id AS rule_id, 1 AS version, CASE WHEN n%4<>0 THEN enabled ELSE true END AS enabled,
      CASE WHEN n%3=0 THEN 10000e0 ELSE CAST(n AS DOUBLE) END AS max_amount, 3600000 AS velocity_window_ms,
      50 AS velocity_max_count, 9900e0 AS structuring_threshold, 24 AS structuring_window_hours,
      CASE WHEN n%2=0 THEN 5 ELSE 3 END AS structuring_min_payments
    FROM ({_CHANGES}) WHERE action<>'delete' AND n%10<>7""",
)
def _(spark, folder):
    c = _rule_changes(spark, folder).filter(F.col("action") != "delete")
    key = F.floor(F.col("seq") / 10)
    body = F.to_json(
        F.struct(
            F.col("id").alias("ruleId"),
            F.when(key % 4 != 0, F.col("enabled")).alias("enabled"),
            F.when(key % 3 != 0, key).alias("maxAmount"),
            F.when(key % 2 == 0, F.lit(5)).alias("structuringMinPayments"),
            F.lit("x").alias("unknownField"),
        )
    )
    return P.parse_rules(records(c, F.when(key % 10 == 7, "{not json").otherwise(body))).drop("offset")


@query(
    "parse_profiles",
    """SELECT 'acc-'||c_custkey AS user_id, CASE WHEN c_custkey%5=0 THEN 0.1e0 ELSE c_acctbal/10000 END AS baseline_risk
    FROM customer WHERE c_custkey%9<>0""",
)
def _(spark, folder):
    c = read_table(spark, folder, "customer")
    key = F.col("c_custkey")
    body = F.to_json(
        F.struct(
            F.when(key % 9 == 0, "  ").otherwise(F.concat(F.lit("acc-"), key)).alias("userId"),
            F.when(key % 5 != 0, F.col("c_acctbal") / 10000).alias("baselineRisk"),
        )
    )
    return P.parse_profiles(records(c, body, offset="c_custkey")).drop("offset")


_SPEC_ERRORS = """
  SELECT id, CASE WHEN n%10=7 THEN 'json_spec is not valid JSON' ELSE concat_ws('; ',
    CASE WHEN round(c_acctbal)<0 THEN 'maxAmount: must be at least 0' END,
    CASE WHEN n%50*100<1000 THEN 'velocityWindowMs: must be at least 1000' END,
    CASE WHEN n%9<1 THEN 'velocityMaxCount: must be at least 1' END,
    CASE WHEN n%200<1 THEN 'structuringWindowHours: must be at least 1' END,
    CASE WHEN n%200>168 THEN 'structuringWindowHours: must be at most 168' END,
    CASE WHEN n%10=3 THEN 'structuringMinPayments: is required' END,
    CASE WHEN n%10=4 THEN 'bogus: is not allowed' END) END AS errors, name
  FROM (%s)"""


@query("rule_spec_errors", _SPEC_ERRORS.replace("%s", "{}").format(_CHANGES))
def _(spark, folder):
    return P.rule_spec_errors(_rule_changes(spark, folder)).select("id", "name", "errors")


@query(
    "payment_request_errors",
    """SELECT idempotency_key, body, requested_at, concat_ws('; ', CASE WHEN amount<=0 THEN 'amount: must be greater than 0' END,
      CASE WHEN currency=' ' THEN 'currency: must not be blank' END) AS errors FROM req""",
)
def _(spark, folder):
    return P.payment_request_errors(S.requests(spark, folder)).select("idempotency_key", "body", "requested_at", "errors")


@query(
    "parse_ts_or_zero",
    """SELECT event_id, CASE seq%4 WHEN 0 THEN occurred_at WHEN 1 THEN date_trunc('second', occurred_at)
      WHEN 2 THEN date_trunc('day', occurred_at) ELSE TIMESTAMP '1970-01-01' END AS at FROM pay""",
)
def _(spark, folder):
    p = S.payments(spark, folder)
    sort = F.col("seq") % 4
    text = (
        F.when(sort == 0, F.date_format("occurred_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'+00:00'"))
        .when(sort == 1, F.unix_seconds("occurred_at").cast("string"))
        .when(sort == 2, F.date_format("occurred_at", "yyyy-MM-dd"))
        .otherwise("yesterday")
    )
    return p.select("event_id", time_or_zero(text).alias("at"))


@query("money_round", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(round(CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(l_tax AS DECIMAL(10,4)), 2) AS DOUBLE) AS tax FROM lineitem")
def _(spark, folder):
    items = read_table(spark, folder, "lineitem")
    exact = F.col("l_extendedprice").cast("decimal(18,4)") * F.col("l_tax").cast("decimal(10,4)")
    return items.select("l_orderkey", "l_linenumber", "l_partkey", money(exact).alias("tax"))


# Landing


@query(
    "land_payments",
    """SELECT event_id, payment_id, CASE WHEN k%10=7 THEN '' ELSE account_id END AS account_id, CAST(amount AS DOUBLE) AS amount,
      currency, merchant_id, occurred_at, seq AS "offset" FROM raw WHERE k%10<>3""",
)
def _(spark, folder):
    return L.land_payments(L.read_payment_topic(S.raw_payments(spark, folder)))


@query(
    "payment_dlq",
    f"""SELECT 'payment.events' AS topic, CAST(seq%3 AS INT) AS "partition", seq AS "offset", value AS raw_message,
      'cannot parse input: not JSON' AS error, TIMESTAMP '{AS_OF}' AS ingested_at FROM raw WHERE k%10=3""",
)
def _(spark, folder):
    return L.payment_dlq(L.read_payment_topic(S.raw_payments(spark, folder)))


@query(
    "land_alerts",
    """SELECT alert_id, user_id, payment_id, score, reasons, rule_id,
      CASE WHEN seq%2=0 THEN CAST(alert_date AS VARCHAR) ELSE '1970-01-01' END AS alert_date,
      CASE WHEN seq%2=0 THEN occurred_at ELSE TIMESTAMP '1970-01-01' END AS occurred_at FROM al""",
)
def _(spark, folder):
    """Landing reads only the epoch field; records with the other form get the zero time."""
    return L.land_alerts(_alert_records(spark, folder)).drop("offset")


def _metric_records(spark, folder):
    hourly = L.metric_records(M.hourly_metrics(S.payments(spark, folder)))
    return records(hourly.withColumn("seq", F.lit(0)), F.col("value"), F.col("key"))


_HOURLY = """
  SELECT date_trunc('hour', occurred_at) AS window_start, date_trunc('hour', occurred_at) + INTERVAL 1 HOUR AS window_end,
    CAST(CAST(occurred_at AS DATE) AS VARCHAR) AS metric_date, currency, count(*) AS payment_count,
    CAST(sum(amount) AS DOUBLE) AS total_amount FROM pay GROUP BY 1,2,3,4"""


@query("land_metrics", _HOURLY)
def _(spark, folder):
    return L.land_metrics(_metric_records(spark, folder)).drop("offset")


@query("hourly_metrics", _HOURLY)
def _(spark, folder):
    return M.hourly_metrics(S.payments(spark, folder))


@query(
    "land_saga_events",
    """SELECT CASE WHEN n%11<>0 THEN saga_id ELSE '' END AS saga_id, saga_type, CASE WHEN n%5<>0 THEN event_type ELSE '' END AS event_type,
      status, step_name, payment_id, CAST(CASE WHEN n%3<>0 THEN attempt ELSE 0 END AS INT) AS attempt, CAST(event_date AS VARCHAR) AS event_date, occurred_at
    FROM (SELECT *, seq//10 AS n FROM sev)""",
)
def _(spark, folder):
    return L.land_saga_events(_saga_records(spark, folder)).drop("offset")


@query(
    "dedup_replacing",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC)=1""",
)
def _(spark, folder):
    order = F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")
    items = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", order.alias("offset")
    )
    return L.dedup_replacing(items, ["l_orderkey", "l_linenumber"]).drop("offset")


@query(
    "dedup_first",
    "SELECT event_id, account_id, CAST(amount AS DOUBLE) AS amount, arrival FROM uniq",
)
def _(spark, folder):
    first = L.dedup_first(S.payment_arrivals(spark, folder), ["event_id"])
    return first.select("event_id", "account_id", "amount", "arrival")


@query(
    "retention_apply",
    "SELECT alert_id, CAST(alert_date AS VARCHAR) AS alert_date FROM al WHERE alert_date + 90 > DATE '2024-04-10'",
)
def _(spark, folder):
    kept = L.retention_apply(
        S.alerts_raw(spark, folder), "alert_date", L.RETENTION_DAYS["fraud_alerts"], literal_time("2024-04-10 00:00:00")
    )
    return kept.select("alert_id", "alert_date")


@query(
    "cdc_route",
    """SELECT 'payment.events' AS topic, id, account_id AS "key",
      '{"eventType":"'||event_type||'","eventVersion":'||version||',"aggregateId":"'||aggregate_id||'"}' AS headers, payload AS value FROM est
    UNION ALL
    SELECT CASE WHEN o_orderkey%10=0 THEN 'Other' ELSE 'saga.commands.start' END, -o_orderkey-1, 'saga-'||o_orderkey, NULL, '{}' FROM ord
    UNION ALL
    SELECT 'fraud_rules', c_custkey, 'rule-'||c_custkey, NULL, '{}' FROM customer""",
)
def _(spark, folder):
    store = S.event_store(spark, folder).select(
        F.lit("event_store").alias("source"), "id", F.col("account_id").alias("key"), F.col("event_type").alias("type"),
        "version", "aggregate_id", "payload",
    )
    outbox = S.orders(spark, folder).select(
        F.lit("outbox").alias("source"),
        (-F.col("o_orderkey") - 1).alias("id"),
        F.concat(F.lit("saga-"), "o_orderkey").alias("key"),
        F.when(F.col("o_orderkey") % 10 == 0, "Other").otherwise("SagaStart:PaymentSaga").alias("type"),
        F.lit("{}").alias("payload"),
    )
    rule_rows = read_table(spark, folder, "customer").select(
        F.lit("rule_outbox").alias("source"), F.col("c_custkey").alias("id"), F.concat(F.lit("rule-"), "c_custkey").alias("key"),
        F.lit("FraudRuleUpdated").alias("type"), F.lit("{}").alias("payload"),
    )
    changes = store.unionByName(outbox, allowMissingColumns=True).unionByName(rule_rows, allowMissingColumns=True)
    return L.cdc_route(changes)


@query(
    "sink_payload",
    """SELECT epoch_ms(window_start)||':'||currency AS "key", currency, payment_count, total_amount FROM (""" + _HOURLY + ")",
)
def _(spark, folder):
    """The metric records, with their value read back: number formats differ between engines."""
    made = L.metric_records(M.hourly_metrics(S.payments(spark, folder)))
    body = F.from_json("value", "currency string, count long, totalAmount double")
    return made.select(
        "key", body["currency"].alias("currency"), body["count"].alias("payment_count"), body["totalAmount"].alias("total_amount")
    )


# Rules


@query(
    "compact_latest",
    f"SELECT id, name, enabled, action, seq FROM ({_CHANGES}) WHERE rn=1",
)
def _(spark, folder):
    return R.compact_latest(_rule_changes(spark, folder), ["id"], "seq").select("id", "name", "enabled", "action", "seq")


@query(
    "active_rule",
    """SELECT event_id, records, CASE records WHEN 2 THEN 'rule-tight' ELSE 'rule-default' END AS rule_id, CAST(1 AS BIGINT) AS version,
      CASE records WHEN 2 THEN 21600000 ELSE 3600000 END AS velocity_window_ms FROM pay, (VALUES (1), (2), (3)) r(records)""",
)
def _(spark, folder):
    """The rule in force after one, two and all three records of the log."""
    made = None
    for records in (1, 2, 3):
        rule = R.active_rule(S.rule_log(spark).filter(F.col("offset") < records))
        one = S.payments(spark, folder).select(
            "event_id",
            F.lit(records).alias("records"),
            F.lit(rule.rule_id).alias("rule_id"),
            F.lit(rule.version).cast("long").alias("version"),
            F.lit(rule.velocity_window_ms).cast("long").alias("velocity_window_ms"),
        )
        made = one if made is None else made.unionByName(one)
    return made


@query(
    "rule_asof",
    """SELECT event_id, CASE WHEN tight THEN 'rule-tight' ELSE 'rule-default' END AS rule_id, CAST(1 AS BIGINT) AS version,
      CASE WHEN tight THEN 21600000 ELSE 3600000 END AS velocity_window_ms FROM sigx""",
)
def _(spark, folder):
    joined = R.rule_asof(S.far_payments(spark, folder), S.rule_log(spark))
    return joined.select("event_id", "rule_id", "version", "velocity_window_ms")


@query(
    "rule_registry",
    f"SELECT id, name, enabled, CAST(version AS BIGINT) AS version, changed_at AS updated_at FROM ({_CHANGES}) WHERE rn=1 AND action<>'delete'",
)
def _(spark, folder):
    return R.rule_registry(_rule_changes(spark, folder)).drop("json_spec")


@query(
    "rules_list",
    f"SELECT name, id, CAST(version AS BIGINT) AS version FROM ({_CHANGES}) WHERE rn=1 AND action<>'delete' ORDER BY name",
)
def _(spark, folder):
    return R.rules_list(R.rule_registry(_rule_changes(spark, folder))).select("name", "id", "version")


@query(
    "rule_payload",
    f"""SELECT id, CAST(version AS BIGINT) AS version, id AS "key", CASE WHEN ok THEN id END AS rule_id, CASE WHEN ok THEN CAST(version AS BIGINT) END AS published_version,
      CASE WHEN ok THEN enabled AND action<>'delete' END AS enabled, CASE WHEN ok THEN CAST(round(c_acctbal) AS BIGINT) END AS max_amount, n%10=4 AS has_extra,
      CASE WHEN NOT ok THEN 'invalid rule spec' END AS error
    FROM (SELECT *, n%10<>7 AS ok FROM ({_CHANGES}))""",
)
def _(spark, folder):
    """The published payload, with its fields read back; some specs are no JSON."""
    body = F.from_json("payload", "ruleId string, version long, enabled boolean, maxAmount long, bogus int")
    return R.rule_payload(R.rule_versions(_rule_changes(spark, folder))).select(
        "id", "version", "key", body["ruleId"].alias("rule_id"), body["version"].alias("published_version"),
        body["enabled"].alias("enabled"), body["maxAmount"].alias("max_amount"), body["bogus"].isNotNull().alias("has_extra"), "error",
    )


# Detection


@query(
    "geo_anomaly",
    "SELECT event_id, merchant_id, contains(lower(merchant_id), ':foreign') AS geo_anomaly FROM pay",
)
def _(spark, folder):
    return S.payments(spark, folder).select("event_id", "merchant_id", D.geo_anomaly().alias("geo_anomaly"))


@query("amount_over_max", "SELECT event_id, amount>10000 AS amount_over_max FROM pay")
def _(spark, folder):
    return S.payments(spark, folder).select("event_id", D.amount_over_max(F.col("amount"), F.lit(10000.0)).alias("amount_over_max"))


@query("participant_fraud_score", "SELECT event_id, CASE WHEN amount>1000 THEN 0.9e0 ELSE 0.05e0 END AS score FROM pay")
def _(spark, folder):
    return S.payments(spark, folder).select("event_id", D.participant_fraud_score(F.col("amount")).alias("score"))


@query(
    "enrich_risk",
    "SELECT event_id, account_id, coalesce(baseline_risk, 0.1e0) AS baseline_risk FROM pay LEFT JOIN prof ON user_id=account_id",
)
def _(spark, folder):
    return D.enrich_risk(S.payments(spark, folder), S.profiles(spark, folder)).select("event_id", "account_id", "baseline_risk")


@query("velocity", "SELECT event_id, account_id, vt AS window_count, vt>2 AS velocity FROM sig")
def _(spark, folder):
    counted = D.velocity(S.payments(spark, folder), 6 * D.HOUR_MS, 2)
    return counted.select("event_id", "account_id", "window_count", "velocity")


@query(
    "structuring",
    "SELECT event_id, account_id, sc AS small_count, CAST(ss AS DOUBLE) AS small_sum, sc>=3 AND ss>9900 AS structuring FROM sig",
)
def _(spark, folder):
    summed = D.structuring(S.payments(spark, folder), 9900.0, 24, 3)
    return summed.select("event_id", "account_id", "small_count", "small_sum", "structuring")


def scored(spark, folder):
    return D.detect_asof(S.far_payments(spark, folder), S.rule_log(spark), S.profiles(spark, folder))


@query("fraud_scores", f"SELECT event_id, account_id, payment_id, rule_id, {SCORE} AS score, {REASONS} AS reasons FROM scoredx")
def _(spark, folder):
    return scored(spark, folder).select("event_id", "account_id", "payment_id", "rule_id", "score", "reasons")


_ALERTS = f"""
  SELECT md5(event_id||'|'||rule_id||'|1') AS alert_id, account_id AS user_id, payment_id, {SCORE} AS score, {REASONS} AS reasons, rule_id,
    occurred_ms, occurred_at, CAST(CAST(occurred_at AS DATE) AS VARCHAR) AS alert_date"""


@query("fraud_alerts", f"SELECT * FROM ({_ALERTS} FROM scoredx) WHERE reasons<>''")
def _(spark, folder):
    return D.fraud_alerts(scored(spark, folder))


@query("fraud_alerts_active_rule", f"SELECT * FROM ({_ALERTS} FROM scored0) WHERE reasons<>''")
def _(spark, folder):
    rule = R.active_rule(S.rule_log(spark))
    return D.fraud_alerts(D.detect(S.payments(spark, folder), rule, S.profiles(spark, folder)))


@query(
    "latest_scores",
    f"SELECT account_id AS user_id, {SCORE} AS score, payment_id AS last_payment_id, occurred_ms AS updated_at FROM scoredx"
    " QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY seq DESC)=1",
)
def _(spark, folder):
    return D.latest_scores(D.user_scores(scored(spark, folder)))


# Alert serving


@query(
    "alerts_search",
    "SELECT alert_id, user_id, rule_id, score FROM sa WHERE contains(lower(user_id), 'acc-1') AND rule_id='rule-2' AND score>=0.3",
)
def _(spark, folder):
    from .warehouse import alerts

    return V.alerts_search(alerts(spark, folder), "ACC-1", "rule-2", 0.3).select("alert_id", "user_id", "rule_id", "score")


@query(
    "alerts_by_severity",
    """SELECT rule_id, CASE WHEN score*2>=0.9 THEN 'critical' WHEN score*2>=0.7 THEN 'high' ELSE 'medium' END AS severity, count(*) AS alerts
    FROM sa GROUP BY 1,2""",
)
def _(spark, folder):
    from .warehouse import alerts

    return V.alerts_by_severity(alerts(spark, folder).withColumn("score", F.col("score") * 2))


_MINUTE_AS_OF = "2024-01-20 12:07:30"


@query(
    "alerts_per_minute",
    f"""SELECT m.minute AS minute, coalesce(n,0) AS alerts FROM
      (SELECT strftime(TIMESTAMP '{_MINUTE_AS_OF}' - to_minutes(i), '%H:%M') AS minute, i FROM range(300) r(i)) m
    LEFT JOIN (SELECT strftime(occurred_at, '%H:%M') AS minute, count(*) AS n FROM sa
      WHERE TIMESTAMP '{_MINUTE_AS_OF}' - occurred_at <= INTERVAL 300 MINUTE AND occurred_at <= TIMESTAMP '{_MINUTE_AS_OF}' GROUP BY 1) c
    ON c.minute=m.minute ORDER BY i DESC""",
)
def _(spark, folder):
    from .warehouse import alerts

    return V.alerts_per_minute(alerts(spark, folder), literal_time(_MINUTE_AS_OF), 300)


@query(
    "recent_alerts",
    "SELECT alert_id, user_id, score FROM al2 ORDER BY seq DESC, alert_id LIMIT 200",
)
def _(spark, folder):
    return V.recent_alerts(S.alerts_raw(spark, folder, second=True)).select("alert_id", "user_id", "score")


@query("recent_payments", "SELECT payment_id, account_id, arrival FROM arr ORDER BY arrival DESC LIMIT 50")
def _(spark, folder):
    return V.recent_payments(S.payment_arrivals(spark, folder)).select("payment_id", "account_id", "arrival")


@query(
    "live_payments",
    """SELECT payment_id, account_id, CAST(amount AS DOUBLE) AS amount, occurred_at FROM
      (SELECT * REPLACE (CASE WHEN live=1 THEN amount+1 ELSE amount END AS amount) FROM
        (SELECT *, 0 AS live FROM arr WHERE k<60 UNION ALL SELECT *, 1 FROM arr WHERE k>=40)
       QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY live DESC, arrival DESC)=1)
    ORDER BY occurred_at DESC, payment_id LIMIT 50""",
)
def _(spark, folder):
    both = S.payment_arrivals(spark, folder)
    live = both.filter(F.col("k") >= 40).withColumn("amount", (F.col("amount") + 1).cast("decimal(19,4)"))
    return V.live_payments(both.filter(F.col("k") < 60), live).select("payment_id", "account_id", "amount", "occurred_at")
