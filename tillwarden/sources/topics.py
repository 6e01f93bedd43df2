"""Topic sources and sinks. Kafka needs the connector package on the cluster; file topics need nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import RAW_RECORD

# Topic names by record type.
TOPICS = {
    "payments": "payment.events",
    "alerts": "fraud_alerts",
    "metrics": "payment_metrics_hourly",
    "saga_events": "saga.events",
    "rules": "fraud_rules",
    "profiles": "user_risk_profiles",
    "scores": "user_fraud_scores",
    "dead_letter": "payment_events_dead_letter",
    "saga_start": "saga.commands.start",
}


def _records(df: DataFrame) -> DataFrame:
    return df.select(
        "topic",
        "partition",
        "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("ingest_ts"),
    )


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Live topic from the checkpointed position, else from the beginning."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    return _records(reader.options(**options).load())


def kafka_table(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Whole compacted topic as a table."""
    reader = spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return _records(reader.load())


def file_stream(spark: SparkSession, folder: str, files_per_batch: int = 64, pattern: str = "*.parquet") -> DataFrame:
    """Topic kept as Parquet files of raw records."""
    return (
        spark.readStream.schema(RAW_RECORD)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", pattern)
        .parquet(folder)
    )


def keyed_json(df: DataFrame, key: Column | None, value: Column) -> DataFrame:
    """Rows as (key, value) with the value as JSON text; ``key=None`` writes unkeyed records."""
    return df.select(
        (key if key is not None else F.lit(None)).cast("string").alias("key"), F.to_json(value).alias("value")
    )


def write_kafka(records: DataFrame, servers: str, topic: str) -> None:
    """At-least-once: a replayed batch repeats its records, so ids in them must be deterministic."""
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
