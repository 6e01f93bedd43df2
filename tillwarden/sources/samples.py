"""Shapes the driver's tables into the payment domain (see FIXTURES.md section 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import MONEY, millis
from .schemas import DEFAULT_RULE, PAYMENT_STEPS
from .tables import read_table

AS_OF = "2024-01-31 00:00:00"
ORDERS_AS_OF = "2001-12-01 00:00:00"


def _cat(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def shape_payments(events: DataFrame) -> DataFrame:
    """Payment events plus ``occurred_ms``, arrival ``seq`` and the selector ``k``."""
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    slot = _cat("m-", F.col("k") % 20)
    merchant = (
        F.when(F.col("k") < 5, "").when(F.col("event_type") == "error", F.concat(slot, F.lit(":foreign"))).otherwise(slot)
    )
    country = F.col("user_id") % 3
    at = millis(F.col("ts").cast("timestamp"))
    return events.withColumn("k", k).select(
        _cat("evt-", F.col("event_id")).alias("event_id"),
        _cat("pay-", F.col("event_id")).alias("payment_id"),
        _cat("acc-", F.col("user_id")).alias("account_id"),
        F.round(F.col("value") * 100, 2).cast(MONEY).alias("amount"),
        F.when(country == 0, "USD").when(country == 1, "EUR").otherwise("GBP").alias("currency"),
        merchant.alias("merchant_id"),
        at.alias("occurred_at"),
        F.unix_millis(at).alias("occurred_ms"),
        F.col("event_id").alias("seq"),
        "k",
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    return shape_payments(read_table(spark, folder, "events"))


def far_payments(spark: SparkSession, folder: str) -> DataFrame:
    """Payments of which some lie sixty years earlier, before 1970, and some a hundred years later."""
    shift = F.when(F.col("seq") % 97 == 0, -1_893_456_000_000).when(F.col("seq") % 97 == 1, 3_155_760_000_000).otherwise(0)
    moved = payments(spark, folder).withColumn("occurred_ms", F.col("occurred_ms") + shift)
    return moved.withColumn("occurred_at", F.timestamp_millis("occurred_ms"))


def payment_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Payments with a late, out-of-order ``arrival`` and repeated deliveries."""
    base = payments(spark, folder).withColumn("arrival", F.col("seq") * 100 + (F.col("seq") % 7) * 300 + F.col("seq") % 100)
    again = F.when(F.col("seq") % 50 == 0, F.array(F.lit(0), F.lit(1_000_000_000_000))).otherwise(F.array(F.lit(0)))
    return (
        base.withColumn("_shift", F.explode(again))
        .withColumn("arrival", F.col("arrival") + F.col("_shift"))
        .drop("_shift")
    )


def raw_payment_records(payments_df: DataFrame) -> DataFrame:
    """JSON topic of the payments; some records are broken, chosen by ``k % 10``."""
    at = F.date_format("occurred_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    amount = F.col("amount").cast("string")
    account = _cat('"accountId":"', F.col("account_id"), '",')
    sort = F.col("k") % 10
    merchant = F.when(F.col("merchant_id") == "", '""').otherwise(_cat('"', F.col("merchant_id"), '"'))
    value = _cat(
        '{"eventId":"', F.col("event_id"), '","paymentId":"', F.col("payment_id"), '",',
        F.when(sort == 7, "").otherwise(account),
        '"amount":', F.when(sort == 9, _cat('"', amount, '"')).otherwise(amount),
        ',"currency":"', F.col("currency"), '","merchantId":', merchant,
        ',"occurredAt":"', at, '"}',
    )
    return payments_df.select(
        F.lit("payment.events").alias("topic"),
        (F.col("seq") % 3).cast("int").alias("partition"),
        F.col("seq").alias("offset"),
        F.col("account_id").alias("key"),
        F.when(sort == 3, "not-json").otherwise(value).alias("value"),
        F.lit(AS_OF).cast("timestamp").alias("ingest_ts"),
    )


def raw_payments(spark: SparkSession, folder: str) -> DataFrame:
    return raw_payment_records(payments(spark, folder))


def profiles(spark: SparkSession, folder: str) -> DataFrame:
    customers = read_table(spark, folder, "customer").filter(F.col("c_custkey") % 4 != 0)
    return customers.select(
        _cat("acc-", F.col("c_custkey")).alias("user_id"),
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("c_acctbal") / 10000)).alias("baseline_risk"),
    )


def rule_log(spark: SparkSession) -> DataFrame:
    """Three rule records in offset order: default, a tight rule, the tight rule disabled."""
    d = DEFAULT_RULE
    tight = f"'rule-tight', {{v}}L, {{on}}, 10000.0D, 21600000L, 2L, {d.structuring_threshold}D, 24L, 3L"
    return spark.sql(
        f"""
        SELECT * FROM VALUES
          (0L, '{d.rule_id}', 1L, true, {d.max_amount}D, {d.velocity_window_ms}L, {d.velocity_max_count}L,
           {d.structuring_threshold}D, {d.structuring_window_hours}L, {d.structuring_min_payments}L,
           timestamp'1970-01-01 00:00:00'),
          (1L, {tight.format(v=1, on='true')}, timestamp'2024-01-10 00:00:00'),
          (2L, {tight.format(v=2, on='false')}, timestamp'2024-01-20 00:00:00')
        AS t(offset, rule_id, version, enabled, max_amount, velocity_window_ms, velocity_max_count,
             structuring_threshold, structuring_window_hours, structuring_min_payments, valid_from)
        """
    )


def alerts_raw(spark: SparkSession, folder: str, second: bool = False) -> DataFrame:
    """Alert rows that do not depend on detection; ``second`` adds a second alert to some payments."""
    p = payments(spark, folder)
    over, foreign = F.col("amount") > 10000, F.col("merchant_id").contains(":foreign")
    weight = F.when(over, 0.35).otherwise(0.0) + F.when(foreign, 0.15).otherwise(0.0) + F.lit(0.2) * F.lit(0.1)
    reasons = F.array_compact(F.array(F.when(over, "amount_over_max"), F.when(foreign, "geo_anomaly")))
    one = p.filter(over | foreign)
    prefixes = F.array(F.lit("al-"))
    if second:
        prefixes = F.when(F.col("seq") % 11 == 0, F.array(F.lit("al-"), F.lit("al2-"))).otherwise(prefixes)
    return one.withColumn("_prefix", F.explode(prefixes)).select(
        _cat(F.col("_prefix"), F.col("seq")).alias("alert_id"),
        F.col("account_id").alias("user_id"),
        "payment_id",
        weight.alias("score"),
        reasons.alias("reasons"),
        F.when(F.col("seq") % 7 == 0, "").otherwise(_cat("rule-", F.col("seq") % 5)).alias("rule_id"),
        F.to_date("occurred_at").alias("alert_date"),
        "occurred_at",
        "occurred_ms",
        "seq",
    )


# Lifecycle paths by order status: C completed, K compensated, X failed, O open.
PATH_EVENTS = """
  ('C', 0, 'SAGA_STARTED', 'STARTED', NULL, 1), ('C', 1, 'STEP_COMPLETED', 'COMPLETED', 'FRAUD_CHECK', 1),
  ('C', 2, 'STEP_COMPLETED', 'COMPLETED', 'RISK_SCORING', 1), ('C', 3, 'STEP_COMPLETED', 'COMPLETED', 'LEDGER_APPLY', 1),
  ('C', 4, 'STEP_COMPLETED', 'COMPLETED', 'NOTIFY', 1), ('C', 5, 'SAGA_COMPLETED', 'COMPLETED', 'NOTIFY', 1),
  ('K', 0, 'SAGA_STARTED', 'STARTED', NULL, 1), ('K', 1, 'STEP_COMPLETED', 'COMPLETED', 'FRAUD_CHECK', 1),
  ('K', 2, 'STEP_COMPLETED', 'COMPLETED', 'RISK_SCORING', 1), ('K', 3, 'STEP_FAILED', 'FAILED', 'LEDGER_APPLY', 1),
  ('K', 4, 'STEP_COMPENSATED', 'COMPENSATED', 'RISK_SCORING', 1), ('K', 5, 'STEP_COMPENSATED', 'COMPENSATED', 'FRAUD_CHECK', 1),
  ('K', 6, 'SAGA_COMPENSATED', 'COMPENSATED', 'FRAUD_CHECK', 1),
  ('X', 0, 'SAGA_STARTED', 'STARTED', NULL, 1), ('X', 1, 'STEP_COMPLETED', 'COMPLETED', 'FRAUD_CHECK', 1),
  ('X', 2, 'STEP_COMPLETED', 'COMPLETED', 'RISK_SCORING', 1), ('X', 3, 'STEP_COMPLETED', 'COMPLETED', 'LEDGER_APPLY', 1),
  ('X', 4, 'STEP_FAILED', 'FAILED', 'NOTIFY', 1), ('X', 5, 'STEP_FAILED', 'FAILED', 'NOTIFY', 2),
  ('X', 6, 'STEP_FAILED', 'FAILED', 'NOTIFY', 3), ('X', 7, 'STEP_FAILED', 'FAILED', 'NOTIFY', 4),
  ('X', 8, 'SAGA_FAILED', 'FAILED', 'NOTIFY', 1),
  ('O', 0, 'SAGA_STARTED', 'STARTED', NULL, 1), ('O', 1, 'STEP_COMPLETED', 'COMPLETED', 'FRAUD_CHECK', 1)
"""
PATH_STEPS = """
  ('C', 'FRAUD_CHECK', 0, 'COMPLETED', 0, 0, 1), ('C', 'RISK_SCORING', 1, 'COMPLETED', 0, 1, 2),
  ('C', 'LEDGER_APPLY', 2, 'COMPLETED', 0, 2, 3), ('C', 'NOTIFY', 3, 'COMPLETED', 0, 3, 4),
  ('K', 'FRAUD_CHECK', 0, 'COMPENSATED', 0, 4, 5), ('K', 'RISK_SCORING', 1, 'COMPENSATED', 0, 3, 4),
  ('K', 'LEDGER_APPLY', 2, 'FAILED', 0, 2, 3), ('K', 'NOTIFY', 3, 'PENDING', 0, NULL, NULL),
  ('X', 'FRAUD_CHECK', 0, 'COMPLETED', 0, 0, 1), ('X', 'RISK_SCORING', 1, 'COMPLETED', 0, 1, 2),
  ('X', 'LEDGER_APPLY', 2, 'COMPLETED', 0, 2, 3), ('X', 'NOTIFY', 3, 'FAILED', 3, 6, 7),
  ('O', 'FRAUD_CHECK', 0, 'COMPLETED', 0, 0, 1), ('O', 'RISK_SCORING', 1, 'EXECUTING', 0, 1, NULL),
  ('O', 'LEDGER_APPLY', 2, 'PENDING', 0, NULL, NULL), ('O', 'NOTIFY', 3, 'PENDING', 0, NULL, NULL)
"""
PATH_ENDS = """
  ('C', 'COMPLETED', 'NOTIFY', 5), ('K', 'COMPENSATED', 'FRAUD_CHECK', 6),
  ('X', 'FAILED', 'NOTIFY', 8), ('O', 'EXECUTING', 'RISK_SCORING', 1)
"""


def shape_orders(table: DataFrame) -> DataFrame:
    """Orders as lifecycles: path, start and the gap ``u`` in seconds between events."""
    low = F.substring("o_orderpriority", 1, 1).cast("int") <= 3
    path = (
        F.when(F.col("o_orderstatus") == "F", "C")
        .when((F.col("o_orderstatus") == "P") & low, "K")
        .when(F.col("o_orderstatus") == "P", "X")
        .otherwise("O")
    )
    return table.select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        path.alias("path"),
        F.col("o_orderdate").alias("start"),
        (F.col("o_orderkey") % 30 + 1).alias("u"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return shape_orders(read_table(spark, folder, "orders"))


def _values(spark: SparkSession, rows: str, columns: str) -> DataFrame:
    """Fixed list of a few rows."""
    return F.broadcast(spark.sql(f"SELECT * FROM VALUES {rows} AS t({columns})"))


def _after(i: Column) -> Column:
    return F.timestamp_micros(F.unix_micros("start") + i * F.col("u") * 1_000_000)


def saga_events(spark: SparkSession, folder: str) -> DataFrame:
    return shape_saga_events(orders(spark, folder))


def shape_saga_events(sagas: DataFrame) -> DataFrame:
    path = _values(sagas.sparkSession, PATH_EVENTS, "path, i, event_type, status, step_name, attempt")
    at = _after(F.col("i"))
    return sagas.join(path, "path").select(
        _cat("saga-", F.col("o_orderkey")).alias("saga_id"),
        F.lit("PaymentSaga").alias("saga_type"),
        "event_type",
        "status",
        "step_name",
        _cat("pay-", F.col("o_orderkey")).alias("payment_id"),
        F.col("attempt").cast("int").alias("attempt"),
        F.to_date(at).alias("event_date"),
        at.alias("occurred_at"),
        (F.col("o_orderkey") * 10 + F.col("i")).alias("seq"),
    )


def saga_replies(spark: SparkSession, folder: str) -> DataFrame:
    steps = saga_events(spark, folder).filter(F.col("step_name").isNotNull() & F.col("event_type").startswith("STEP_"))
    key = F.substring_index("saga_id", "-", -1)
    ok = F.col("event_type") != "STEP_FAILED"
    payload = (
        F.when(F.col("step_name") == "FRAUD_CHECK", F.lit('{"score":0.12}'))
        .when(F.col("step_name") == "RISK_SCORING", F.lit('{"score":0.2}'))
        .when(F.col("step_name") == "LEDGER_APPLY", _cat('{"ledgerEventId":"led-', key, '"}'))
        .otherwise(_cat('{"notificationId":"ntf-', key, '"}'))
    )
    return steps.select(
        "saga_id",
        "seq",
        "step_name",
        F.when(ok, "SUCCESS").otherwise("FAILURE").alias("status"),
        F.when(F.col("event_type") == "STEP_COMPLETED", payload).alias("payload"),
        F.when(~ok, _cat("declined by ", F.col("step_name"))).alias("error_message"),
        (F.col("event_type") == "STEP_COMPENSATED").alias("is_compensation"),
        "occurred_at",
    )


def saga_instances(spark: SparkSession, folder: str) -> DataFrame:
    ends = _values(spark, PATH_ENDS, "path, status, current_step, last")
    updated = _after(F.col("last"))
    return orders(spark, folder).join(ends, "path").select(
        F.col("o_orderkey").alias("id"),
        _cat("saga-", F.col("o_orderkey")).alias("saga_id"),
        F.lit("PaymentSaga").alias("saga_type"),
        "status",
        "current_step",
        F.to_json(
            F.struct(
                _cat("pay-", F.col("o_orderkey")).alias("paymentId"),
                _cat("acc-", F.col("o_custkey")).alias("accountId"),
                F.col("o_totalprice").cast("decimal(19,2)").alias("amount"),
            )
        ).alias("payload"),
        F.col("start").alias("created_at"),
        updated.alias("updated_at"),
        F.when(F.col("path") != "O", updated).alias("completed_at"),
    )


def saga_steps(spark: SparkSession, folder: str) -> DataFrame:
    return shape_saga_steps(spark, orders(spark, folder))


def shape_saga_steps(spark: SparkSession, orders_df: DataFrame) -> DataFrame:
    steps = _values(spark, PATH_STEPS, "path, step_name, step_order, status, retry_count, i0, i1")
    types = F.create_map(*[F.lit(x) for s in PAYMENT_STEPS for x in (s.name, s.step_type)])
    return orders_df.join(steps, "path").select(
        (F.col("o_orderkey") * 4 + F.col("step_order")).alias("id"),
        F.col("o_orderkey").alias("saga_instance_id"),
        "step_name",
        types[F.col("step_name")].alias("step_type"),
        F.col("step_order").cast("int").alias("step_order"),
        "status",
        F.when(F.col("status") == "FAILED", _cat("declined by ", F.col("step_name"))).alias("error_message"),
        F.col("retry_count").cast("int").alias("retry_count"),
        _after(F.col("i0")).alias("started_at"),
        _after(F.col("i1")).alias("completed_at"),
    )


def compensation_log(spark: SparkSession, folder: str) -> DataFrame:
    """Failure and resolve entries; sagas divisible by 4 were never recorded, by 7 re-opened."""
    failed = saga_instances(spark, folder).filter((F.col("status") == "FAILED") & (F.col("id") % 4 != 0))
    entries = F.array_compact(
        F.array(
            F.struct(F.lit(0).alias("step"), F.lit("FAILED").alias("action")),
            F.when(F.col("id") % 5 == 0, F.struct(F.lit(1).alias("step"), F.lit("RESOLVED").alias("action"))),
            F.when(F.col("id") % 35 == 0, F.struct(F.lit(2).alias("step"), F.lit("FAILED").alias("action"))),
        )
    )
    return failed.withColumn("_e", F.explode(entries)).select(
        "saga_id",
        (F.col("id") * 10 + F.col("_e.step")).alias("seq"),
        F.col("_e.action").alias("action"),
        F.when(F.col("_e.action") == "FAILED", _cat("Saga failed at step ", F.col("current_step"))).alias("reason"),
        F.col("payload"),
        F.timestamp_micros(F.unix_micros("updated_at") + F.col("_e.step") * 60_000_000).alias("at"),
    )


def event_store(spark: SparkSession, folder: str) -> DataFrame:
    """Initiated (and settled) payment events; some first versions are repeated by mistake."""
    repeat = F.col("o_orderkey") % 97 == 0
    initiated = F.struct(F.lit(1).alias("version"), F.lit("PaymentInitiatedV1").alias("event_type"), F.lit(0).alias("i"), F.lit(0).alias("copy"))
    settled = F.struct(F.lit(2).alias("version"), F.lit("PaymentSettledV1").alias("event_type"), F.lit(4).alias("i"), F.lit(0).alias("copy"))
    again = F.struct(F.lit(1).alias("version"), F.lit("PaymentInitiatedV1").alias("event_type"), F.lit(1).alias("i"), F.lit(1).alias("copy"))
    rows = F.array_compact(F.array(initiated, F.when(F.col("path") == "C", settled), F.when(repeat, again)))
    return orders(spark, folder).withColumn("_e", F.explode(rows)).select(
        (F.col("o_orderkey") * 10 + F.col("_e.version") + F.col("_e.copy") * 5).alias("id"),
        _cat("pay-", F.col("o_orderkey")).alias("aggregate_id"),
        F.lit("Payment").alias("aggregate_type"),
        F.col("_e.event_type").alias("event_type"),
        F.col("_e.version").alias("version"),
        _cat("acc-", F.col("o_custkey")).alias("account_id"),
        _cat('{"amount":', F.col("o_totalprice").cast("decimal(19,2)"), "}").alias("payload"),
        _after(F.col("_e.i")).alias("occurred_at"),
    )


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """Payment requests with reused idempotency keys; the struct ``arrival`` orders the requests of a key."""
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_suppkey", "l_extendedprice", "l_shipdate"]
    items = read_table(spark, folder, "lineitem").select(*cols)
    return items.select(
        _cat("key-", F.col("l_orderkey"), "-", F.col("l_linenumber")).alias("idempotency_key"),
        _cat(F.col("l_partkey"), "|", F.col("l_quantity").cast("int")).alias("body"),
        F.struct("l_shipdate", "l_partkey", "l_quantity", "l_suppkey", "l_extendedprice").alias("arrival"),
        _cat("acc-", F.col("l_suppkey")).alias("account_id"),
        (F.col("l_quantity") - 3).cast(MONEY).alias("amount"),
        F.when(F.col("l_partkey") % 13 == 0, " ").otherwise("USD").alias("currency"),
        F.col("l_shipdate").alias("requested_at"),
    )
