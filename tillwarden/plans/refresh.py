"""Full refresh of the warehouse, layer by layer, and the checks that belong to each table.

Every table is written, and each layer reads the written one below it, so raw tables are scanned and reduced
once. Intermediate models stay lazy: one table reads each of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import landing, quality
from ..operators import warehouse as W
from ..sources.tables import write_table

RAW = ("payment_events", "fraud_alerts", "payment_metrics_hourly", "saga_events")


def staging(raw: dict[str, DataFrame], as_of: Column | None = None) -> dict[str, DataFrame]:
    """Staged tables. Raw rows with an equal sort key are reduced to the last one, expired ones left out."""
    dates = {"fraud_alerts": "alert_date", "payment_metrics_hourly": "metric_date", "saga_events": "event_date"}
    stage = {
        "payment_events": W.stg_payment_events,
        "fraud_alerts": W.stg_fraud_alerts,
        "payment_metrics_hourly": W.stg_payment_metrics_hourly,
        "saga_events": W.stg_saga_events,
    }
    staged = {}
    for name, df in raw.items():
        if as_of is not None and name in dates:
            df = landing.retention_apply(df, dates[name], landing.RETENTION_DAYS[name], as_of)
        if "offset" in df.columns:
            df = landing.dedup_replacing(df, landing.SORT_KEYS[name])
        staged[f"stg_{name}"] = stage[name](df)
    return staged


def refresh(spark: SparkSession, raw: dict[str, DataFrame], path: str, as_of: Column) -> dict[str, DataFrame]:
    """Writes staged tables, dimensions, facts and marts below ``path`` and returns every table by name.

    Raw rows that have expired at ``as_of`` are left out.
    """
    staged = staging(raw, as_of)
    tables: dict[str, DataFrame] = {}

    def save(name: str, df: DataFrame, month_of: str | None = None, sort_by=()) -> None:
        write_table(df, f"{path}/{name}", month_of, sort_by)
        tables[name] = spark.read.parquet(f"{path}/{name}").drop("month")

    for name, df in staged.items():
        save(name, df)
    payments, alerts = tables["stg_payment_events"], tables["stg_fraud_alerts"]
    save("dim_account", W.dim_account(W.int_accounts_latest(payments)))
    save("dim_merchant", W.dim_merchant(W.int_merchants_latest(payments)))
    save("dim_currency", W.dim_currency(W.int_currencies(payments)))
    save("dim_rule", W.dim_rule(W.int_rules_latest(alerts)))
    save("fct_payments", W.fct_payments(payments), "event_date", ["account_id", "occurred_at"])
    save("fct_fraud_alerts", W.fct_fraud_alerts(alerts, tables["dim_account"]), "alert_date", ["user_id"])
    paid, alerted = tables["fct_payments"], tables["fct_fraud_alerts"]
    save("mart_daily_revenue", W.mart_daily_revenue(paid))
    save("mart_daily_risk_report", W.mart_daily_risk_report(alerted))
    save("mart_aml_structuring_patterns", W.mart_aml_structuring_patterns(paid))
    save("mart_customer_risk_rfm", W.mart_customer_risk_rfm(W.int_customer_activity(payments, alerts), as_of))
    save("mart_merchant_risk_profile", W.mart_merchant_risk_profile(paid, alerted))
    save("mart_settlement_latency", W.mart_settlement_latency(tables["stg_saga_events"]))
    return tables


# The checks of each table.
NOT_NULL = {
    "stg_payment_events": ["event_id", "currency"],
    "stg_fraud_alerts": ["alert_id"],
    "stg_payment_metrics_hourly": ["currency"],
    "stg_saga_events": ["saga_id"],
    "dim_account": ["account_sk", "account_id"],
    "dim_merchant": ["merchant_sk", "merchant_id"],
    "dim_currency": ["currency_sk", "currency_code"],
    "dim_rule": ["rule_sk", "rule_id"],
    "fct_payments": ["payment_sk", "account_sk", "currency_sk"],
    "fct_fraud_alerts": ["alert_sk"],
    "mart_daily_risk_report": ["report_date"],
    "mart_aml_structuring_patterns": ["account_id"],
    "mart_customer_risk_rfm": ["account_id"],
    "mart_settlement_latency": ["saga_id"],
    "mart_merchant_risk_profile": ["merchant_id"],
    "mart_daily_revenue": ["revenue_date"],
}
UNIQUE = {
    "stg_payment_events": ["event_id"],
    "stg_fraud_alerts": ["alert_id"],
    "dim_account": ["account_sk", "account_id"],
    "dim_merchant": ["merchant_sk", "merchant_id"],
    "dim_currency": ["currency_sk", "currency_code"],
    "dim_rule": ["rule_sk", "rule_id"],
    "fct_payments": ["payment_sk"],
    "fct_fraud_alerts": ["alert_sk"],
    "mart_customer_risk_rfm": ["account_id"],
}
POSITIVE = {
    "stg_payment_events": ["amount"],
    "stg_payment_metrics_hourly": ["total_amount"],
    "fct_payments": ["amount"],
    "mart_aml_structuring_patterns": ["daily_total"],
    "mart_settlement_latency": ["latency_seconds"],
    "mart_daily_revenue": ["total_revenue"],
}
SCORES = {
    "stg_fraud_alerts": ["score"],
    "fct_fraud_alerts": ["score"],
    "mart_daily_risk_report": ["avg_fraud_score"],
}
RELATIONS = [
    ("fct_payments", "account_sk", "dim_account"),
    ("fct_payments", "merchant_sk", "dim_merchant"),
    ("fct_payments", "currency_sk", "dim_currency"),
    ("fct_fraud_alerts", "account_sk", "dim_account"),
    ("fct_fraud_alerts", "rule_sk", "dim_rule"),
]
SEGMENTS = ("LOW", "MEDIUM", "HIGH")


def check_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations per check. Row checks of a table share one scan, and so do its unique keys."""
    parts = []

    def count(name: str, df: DataFrame) -> None:
        parts.append(df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations"))

    for table, df in tables.items():
        broken: dict[str, Column] = {}
        for c in NOT_NULL.get(table, []):
            broken[f"{table}.{c}.not_null"] = F.col(c).isNull()
        for c in POSITIVE.get(table, []):
            broken[f"{table}.{c}.positive_amount"] = F.col(c) < 0
        for c in SCORES.get(table, []):
            broken[f"{table}.{c}.score_range"] = (F.col(c) < 0) | (F.col(c) > 1)
        if table == "mart_customer_risk_rfm":
            broken[f"{table}.risk_segment.accepted_values"] = ~F.col("risk_segment").isin(*SEGMENTS)
        if broken:
            pairs = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"`{n}`").alias("violations")) for n in broken])
            counted = df.agg(*[F.count_if(test).alias(n) for n, test in broken.items()])
            parts.append(counted.select(F.inline(pairs)))
        keys = UNIQUE.get(table, [])
        if keys:
            # a column without any value has no row of its own
            zeros = df.sparkSession.createDataFrame([(c, 0) for c in keys], "column string, violations long")
            found = quality.unique_counts(df, keys).unionByName(zeros).groupBy("column").agg(F.max("violations").alias("violations"))
            parts.append(found.select(F.concat(F.lit(f"{table}."), "column", F.lit(".unique")).alias("check_name"), "violations"))
    for child, column, parent in RELATIONS:
        if child in tables and parent in tables:
            count(f"{child}.{column}.relationships", quality.relationships(tables[child], column, tables[parent], column))
    return reduce(DataFrame.unionByName, parts)


def failing(report: DataFrame) -> DataFrame:
    return report.filter(F.col("violations") > 0)
