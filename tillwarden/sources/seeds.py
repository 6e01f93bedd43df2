"""Rows that a new installation starts from: the default rule, two risk profiles and the first registry entry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import RAW_RECORD

# Key and JSON value of the seeded records.
RULE_RECORDS = [
    (
        "rule-default",
        '{"ruleId":"rule-default","version":1,"enabled":true,"maxAmount":10000,"velocityWindowMs":3600000,"velocityMaxCount":50,'
        '"structuringThreshold":9900,"structuringWindowHours":24,"structuringMinPayments":3}',
    )
]
PROFILE_RECORDS = [("acc-1", '{"userId":"acc-1","baselineRisk":0.1}'), ("acc-2", '{"userId":"acc-2","baselineRisk":0.2}')]
# Id, name, enabled, spec and version of the seeded registry row.
REGISTRY_ROWS = [
    (
        "00000000-0000-0000-0000-000000000001",
        "default-velocity",
        True,
        '{"maxAmount":10000,"velocityWindowMs":3600000,"velocityMaxCount":20,"structuringThreshold":9900,"structuringWindowHours":24,"structuringMinPayments":5}',
        1,
    )
]


def _records(spark: SparkSession, topic: str, rows: list[tuple[str, str]], ingest_ts: Column) -> DataFrame:
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(rows)], "offset long, key string, value string")
    made = df.withColumns({"topic": F.lit(topic), "partition": F.lit(0), "ingest_ts": ingest_ts})
    return made.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_RECORD])


def rule_seeds(spark: SparkSession, ingest_ts: Column) -> DataFrame:
    """Records of the rule topic."""
    return _records(spark, "fraud_rules", RULE_RECORDS, ingest_ts)


def profile_seeds(spark: SparkSession, ingest_ts: Column) -> DataFrame:
    """Records of the profile topic."""
    return _records(spark, "user_risk_profiles", PROFILE_RECORDS, ingest_ts)


def registry_seeds(spark: SparkSession, existing: DataFrame, at: Column) -> DataFrame:
    """Registry rows whose name is not there yet."""
    rows = spark.createDataFrame(REGISTRY_ROWS, "id string, name string, enabled boolean, json_spec string, version long")
    return rows.withColumn("updated_at", at).join(existing.select("name"), "name", "left_anti").select(
        "id", "name", "enabled", "json_spec", "version", "updated_at"
    )
