"""Star schema and marts, layer by layer: staging, intermediate, dimensions, facts, marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import or_unknown, surrogate_key, wide_sum
from ..functions.joins import lookup_join, salted_join
from ..functions.ordered import hot_keys

# Thresholds of the marts.
STRUCTURING_THRESHOLD = 9900
STRUCTURING_MIN_PAYMENTS = 3
HIGH_RISK_SCORE = 0.8


# Staging


def stg_payment_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        "event_id",
        "payment_id",
        "account_id",
        "amount",
        "currency",
        or_unknown("merchant_id").alias("merchant_id"),
        "occurred_at",
        F.to_date("occurred_at").alias("event_date"),
    )


def stg_fraud_alerts(raw: DataFrame) -> DataFrame:
    return raw.select(
        "alert_id",
        "user_id",
        "payment_id",
        "score",
        "reasons",
        or_unknown("rule_id").alias("rule_id"),
        "alert_date",
        "occurred_at",
    )


def stg_payment_metrics_hourly(raw: DataFrame) -> DataFrame:
    return raw.select("window_start", "window_end", "metric_date", "currency", "payment_count", "total_amount")


def stg_saga_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        "saga_id", "saga_type", "event_type", "status", "step_name", "payment_id", "attempt", "event_date", "occurred_at"
    )


# Intermediate


def _seen(count_name: str) -> list[Column]:
    return [
        F.min("occurred_at").alias("first_seen_at"),
        F.max("occurred_at").alias("last_seen_at"),
        F.count(F.lit(1)).alias(count_name),
    ]


def int_accounts_latest(payments: DataFrame) -> DataFrame:
    return payments.groupBy("account_id").agg(*_seen("payment_count"))


def int_currencies(payments: DataFrame) -> DataFrame:
    return payments.groupBy("currency").agg(F.count(F.lit(1)).alias("payment_count"))


def int_merchants_latest(payments: DataFrame) -> DataFrame:
    return payments.groupBy("merchant_id").agg(*_seen("payment_count"), wide_sum("amount").alias("total_amount"))


def int_rules_latest(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("rule_id").agg(*_seen("alert_count"))


def int_payments_with_alerts(payments: DataFrame, alerts: DataFrame) -> DataFrame:
    """Payments with each of their alerts; a payment without one keeps a row."""
    right = alerts.select(
        "payment_id", "alert_id", F.col("score").alias("fraud_score"), "rule_id", F.col("reasons").alias("fraud_reasons")
    )
    return salted_join(payments, right, ["payment_id"], "left")


def exact_sum(score: str) -> Column:
    """Sum of scores as decimals: it does not depend on the order of its rows."""
    return F.sum(F.col(score).cast("decimal(18,12)"))


def _alerts_per_payment(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("payment_id").agg(
        F.count(F.lit(1)).alias("_alerts"), exact_sum("score").alias("_score_sum"), F.max("score").alias("_score_max")
    )


def int_customer_activity(payments: DataFrame, alerts: DataFrame) -> DataFrame:
    """Both sides are reduced to one row per payment id (and account) before they meet.

    Payments are dealt by payment id once: the aggregation and the join both find them there.
    """
    dealt = payments.select("account_id", "payment_id", "occurred_at", "amount").repartition("payment_id")
    paid = dealt.groupBy("account_id", "payment_id").agg(
        F.max("occurred_at").alias("_last"), F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_amount")
    )
    risk = alerts.groupBy("payment_id").agg(F.max("score").alias("_score_max"))
    risky = F.when(F.col("_score_max") >= HIGH_RISK_SCORE, F.col("_n")).otherwise(0)
    return (
        paid.join(risk, "payment_id", "left")
        .groupBy("account_id")
        .agg(
            F.max("_last").alias("last_payment_at"),
            F.sum("_n").alias("payment_count"),
            wide_sum("_amount").alias("total_amount"),
            F.sum(risky).cast("long").alias("high_risk_payment_count"),
        )
    )


# Dimensions


def dim_account(accounts: DataFrame) -> DataFrame:
    return accounts.select(
        surrogate_key("account_id").alias("account_sk"), "account_id", "first_seen_at", "last_seen_at", "payment_count"
    )


def dim_merchant(merchants: DataFrame) -> DataFrame:
    """The validity columns are constants: there is one version per merchant."""
    return merchants.select(
        surrogate_key("merchant_id").alias("merchant_sk"),
        "merchant_id",
        "first_seen_at",
        "last_seen_at",
        "payment_count",
        "total_amount",
        F.lit("1970-01-01 00:00:00").cast("timestamp").alias("valid_from"),
        F.lit("2099-12-31 23:59:59").cast("timestamp").alias("valid_to"),
        F.lit(1).alias("is_current"),
    )


def dim_currency(currencies: DataFrame) -> DataFrame:
    return currencies.select(surrogate_key("currency").alias("currency_sk"), F.col("currency").alias("currency_code"))


def dim_rule(rules: DataFrame) -> DataFrame:
    return rules.select(surrogate_key("rule_id").alias("rule_sk"), "rule_id", "first_seen_at", "last_seen_at", "alert_count")


# Facts

_PAYMENT_FACT = [
    "payment_sk", "event_id", "payment_id", "account_id", "merchant_id", "currency", "amount", "occurred_at",
    "event_date", "account_sk", "merchant_sk", "currency_sk",
]


def fct_payments(payments: DataFrame) -> DataFrame:
    """Payment facts for a full refresh, without a shuffle.

    The dimensions hold exactly the keys of these payments, and a surrogate key is a hash of its
    natural key. So the joins would only drop rows without an account or currency.
    """
    return (
        payments.filter(F.col("account_id").isNotNull() & F.col("currency").isNotNull())
        .withColumns(
            {
                "payment_sk": surrogate_key("event_id"),
                "account_sk": surrogate_key("account_id"),
                "merchant_sk": F.when(F.col("merchant_id").isNotNull(), surrogate_key("merchant_id")),
                "currency_sk": surrogate_key("currency"),
            }
        )
        .select(*_PAYMENT_FACT)
    )


def fct_payments_from(payments: DataFrame, accounts: DataFrame, merchants: DataFrame, currencies: DataFrame) -> DataFrame:
    """Payment facts against dimensions built elsewhere, whose keys may be missing."""
    joined = payments.withColumn("payment_sk", surrogate_key("event_id"))
    codes = currencies.select("currency_sk", F.col("currency_code").alias("currency"))
    for dim, key, how in (
        (codes, "currency", "inner"),
        (merchants.select("merchant_sk", "merchant_id"), "merchant_id", "left"),
        (accounts.select("account_sk", "account_id"), "account_id", "inner"),
    ):
        joined = lookup_join(joined, dim, [key], how, hot=hot_keys(payments, [key]))
    return joined.select(*_PAYMENT_FACT)


def fct_fraud_alerts(alerts: DataFrame, accounts: DataFrame) -> DataFrame:
    """Alert facts. Rules come from the alerts themselves, so only the account is looked up."""
    known = accounts.select("account_sk", F.col("account_id").alias("user_id"))
    return lookup_join(alerts, known, ["user_id"], "left").select(
        surrogate_key("alert_id").alias("alert_sk"),
        "alert_id",
        "user_id",
        "payment_id",
        "rule_id",
        "score",
        "reasons",
        "alert_date",
        "occurred_at",
        "account_sk",
        F.when(F.col("rule_id").isNotNull(), surrogate_key("rule_id")).alias("rule_sk"),
    )


# Marts


def mart_daily_revenue(payments: DataFrame) -> DataFrame:
    """The average is a quotient of the exact sum, in double."""
    return (
        payments.groupBy(F.col("event_date").alias("revenue_date"), "currency")
        .agg(F.count(F.lit(1)).alias("payment_count"), wide_sum("amount").alias("total_revenue"), F.count("amount").alias("_n"))
        .withColumn("avg_payment_amount", F.col("total_revenue").cast("double") / F.col("_n"))
        .drop("_n")
        .orderBy("revenue_date", "currency")
    )


def mart_daily_risk_report(alerts: DataFrame) -> DataFrame:
    return (
        alerts.groupBy(F.col("alert_date").alias("report_date"))
        .agg(
            F.count(F.lit(1)).alias("alert_count"),
            (exact_sum("score").cast("double") / F.count("score")).alias("avg_fraud_score"),
            F.max("score").alias("max_fraud_score"),
            F.countDistinct("user_id").alias("affected_users"),
            F.countDistinct("rule_id").alias("triggered_rules"),
        )
        .orderBy("report_date")
    )


def mart_aml_structuring_patterns(payments: DataFrame, threshold: int | float = STRUCTURING_THRESHOLD) -> DataFrame:
    return (
        payments.filter(F.col("amount") < threshold)
        .groupBy("account_id", "event_date")
        .agg(
            F.count(F.lit(1)).alias("payment_count"),
            wide_sum("amount").alias("daily_total"),
            F.max("amount").alias("max_single_amount"),
        )
        .filter((F.col("payment_count") >= STRUCTURING_MIN_PAYMENTS) & (F.col("daily_total") >= threshold))
    )


def mart_customer_risk_rfm(activity: DataFrame, as_of: Column) -> DataFrame:
    risky = F.col("high_risk_payment_count")
    return activity.select(
        "account_id",
        F.datediff(as_of, "last_payment_at").alias("recency_days"),
        F.col("payment_count").alias("frequency"),
        F.col("total_amount").alias("monetary"),
        risky,
        F.when(risky >= 3, "HIGH").when(risky >= 1, "MEDIUM").otherwise("LOW").alias("risk_segment"),
    )


def mart_merchant_risk_profile(payments: DataFrame, alerts: DataFrame, dedup: bool = False) -> DataFrame:
    """Merchant totals over payments joined with their alerts.

    A payment with k alerts counts k times, in count and total. The pairs are never built: counts per
    payment are multiplied instead. With ``dedup`` each payment counts once. Payments are dealt by payment id once.
    """
    dealt = payments.select("merchant_id", "payment_id", "amount").repartition("payment_id")
    paid = dealt.groupBy("merchant_id", "payment_id").agg(F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_amount"))
    alerts_of = F.coalesce(F.col("_alerts"), F.lit(0))
    times = F.lit(1) if dedup else F.greatest(alerts_of, F.lit(1))
    return (
        paid.join(_alerts_per_payment(alerts), "payment_id", "left")
        .groupBy("merchant_id")
        .agg(
            F.sum(F.col("_n") * times).alias("payment_count"),
            wide_sum((F.col("_amount") * times).cast("decimal(38,4)")).alias("total_amount"),
            F.sum(F.col("_n") * alerts_of).alias("alert_count"),
            F.sum(F.col("_n") * F.col("_score_sum").cast("decimal(28,12)")).cast("double").alias("_scores"),
            F.max("_score_max").alias("max_fraud_score"),
        )
        .withColumn("avg_fraud_score", F.try_divide("_scores", "alert_count"))
        .drop("_scores")
    )


def mart_settlement_latency(saga_events: DataFrame) -> DataFrame:
    """First start and first completion per saga in one pass; sagas without either are left out."""

    def first(event_type: str) -> Column:
        return F.min(F.when(F.col("event_type") == event_type, F.col("occurred_at")))

    return (
        saga_events.filter(F.col("event_type").isin("SAGA_STARTED", "SAGA_COMPLETED"))
        .groupBy("saga_id")
        .agg(first("SAGA_STARTED").alias("started_at"), first("SAGA_COMPLETED").alias("completed_at"))
        .filter(F.col("started_at").isNotNull() & F.col("completed_at").isNotNull())
        .withColumn("latency_seconds", F.unix_timestamp("completed_at") - F.unix_timestamp("started_at"))
    )
