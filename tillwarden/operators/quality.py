"""Data-quality checks. Each returns the violating rows; an empty result passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import WIDE_MONEY, wide_sum


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    known = df
    for c in columns:
        known = known.filter(F.col(c).isNotNull())
    return known.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def unique_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column`` and ``violations``: repeated values of each of several columns, from one scan and one shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    values = df.select(F.inline(pairs)).filter(F.col("value").isNotNull())
    repeated = values.groupBy("column", "value").agg((F.count(F.lit(1)) > 1).cast("long").alias("more"))
    return repeated.groupBy("column").agg(F.sum("more").alias("violations"))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Key values of the child that the parent lacks. NULLs are ignored.

    Both sides are reduced to distinct keys first, so a hot key costs one row.
    """
    keys = child.select(F.col(column).alias(field)).filter(F.col(field).isNotNull()).groupBy(field)
    found = keys.agg(F.count(F.lit(1)).alias("rows"))
    return found.join(parent.select(field).distinct(), field, "left_anti").withColumnRenamed(field, column)


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    other = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))
    return other.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def positive_amount(df: DataFrame, column: str) -> DataFrame:
    """Only negative values break it; zero passes."""
    return df.filter(F.col(column) < 0)


def score_in_range(df: DataFrame, column: str, low: float = 0.0, high: float = 1.0) -> DataFrame:
    return df.filter((F.col(column) < low) | (F.col(column) > high))


def freshness(df: DataFrame, time: str, as_of: Column) -> DataFrame:
    """One row when the table is empty or its newest date is before yesterday."""
    newest = df.agg(F.count(F.lit(1)).alias("rows"), F.to_date(F.max(time)).alias("newest_date"))
    late = F.col("newest_date") < F.date_sub(F.to_date(as_of), 1)
    return newest.filter((F.col("rows") == 0) | late)


def balance_reconcile(balances: DataFrame, events: DataFrame) -> DataFrame:
    """Accounts whose current balance is not the sum of their deltas, on either side."""
    keys = ["account_id", "currency"]
    summed = events.groupBy(*keys).agg(wide_sum("delta").alias("delta_sum"))
    stated = balances.select(*keys, F.col("balance").cast(WIDE_MONEY).alias("balance"))
    zero = F.lit(0).cast(WIDE_MONEY)
    joined = stated.join(summed, keys, "full")
    difference = F.coalesce("balance", zero) - F.coalesce("delta_sum", zero)
    return joined.withColumn("difference", difference.cast(WIDE_MONEY)).filter(F.col("difference") != 0)


def event_version(events: DataFrame) -> DataFrame:
    return unique(events, "aggregate_id", "version")
