"""Table sources and sinks: Parquet by default, JDBC with pushdown where a database is named."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import use_utc


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table; zone-less times become UTC timestamps so that they can carry watermarks."""
    use_utc(spark)
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    return utc_times(df)


def utc_times(df: DataFrame) -> DataFrame:
    plain = {f.name: F.col(f.name).cast("timestamp") for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)}
    return df.withColumns(plain) if plain else df


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """Operational tables; pass partitionColumn, lowerBound, upperBound and numPartitions to split."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def write_table(
    df: DataFrame,
    path: str,
    month_of: str | None = None,
    sort_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Parquet sink, split by calendar month of ``month_of`` and sorted inside files for row-group pruning.

    The rebalance hint brings a month together and lets adaptive execution cut a large one into several
    files, so there are neither tiny files nor one writer per month.
    """
    if month_of:
        df = df.withColumn("month", F.date_format(month_of, "yyyyMM")).hint("rebalance", "month")
        sort_by = ["month", *sort_by]
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    writer = df.write.mode(mode)
    if month_of:
        writer = writer.partitionBy("month")
    writer.parquet(path)
