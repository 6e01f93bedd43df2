"""Queries behind live views, lists and charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import severity
from ..functions.joins import first_per_key

# Page sizes of the live views.
RECENT_ALERTS = 200
RECENT_DEFAULT = 50
TABLE_ROWS = 50
HISTOGRAM_BINS = 25


def alerts_search(alerts: DataFrame, user: str | None = None, rule_id: str | None = None, min_score: float | None = None) -> DataFrame:
    """Alerts by part of the user id (any case), rule and least score; empty criteria do not filter."""
    if user:
        alerts = alerts.filter(F.lower("user_id").contains(user.lower()))
    if rule_id:
        alerts = alerts.filter(F.col("rule_id") == rule_id)
    if min_score is not None:
        alerts = alerts.filter(F.col("score") >= min_score)
    return alerts


def saga_list(instances: DataFrame, status: str | None = None, saga_type: str | None = None, limit: int = 50, offset: int = 0) -> DataFrame:
    if status is not None:
        instances = instances.filter(F.col("status") == status)
    if saga_type is not None:
        instances = instances.filter(F.col("saga_type") == saga_type)
    return instances.orderBy(F.col("created_at").desc(), "saga_id").offset(offset).limit(limit)


def alerts_by_severity(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("rule_id", severity("score").alias("severity")).agg(F.count(F.lit(1)).alias("alerts"))


def alerts_per_minute(alerts: DataFrame, as_of: Column, minutes: int = 15) -> DataFrame:
    """Alerts per clock minute over the last minutes up to ``as_of``, zero-filled, oldest first."""
    spark = alerts.sparkSession
    label = F.date_format("at", "HH:mm")
    spine = (
        spark.range(minutes)
        .select(F.timestamp_seconds(F.unix_seconds(as_of) - (minutes - 1 - F.col("id")) * 60).alias("at"), "id")
        .select("id", label.alias("minute"))
    )
    age = F.unix_millis(as_of) - F.unix_millis("occurred_at")
    recent = alerts.filter(age.between(0, minutes * 60_000))
    counts = recent.groupBy(F.date_format("occurred_at", "HH:mm").alias("minute")).agg(F.count(F.lit(1)).alias("n"))
    return (
        spine.join(counts, "minute", "left")
        .orderBy("id")
        .select("minute", F.coalesce("n", F.lit(0)).alias("alerts"))
    )


def recent_payments(payments: DataFrame, limit: int = RECENT_DEFAULT, arrival: str = "arrival") -> DataFrame:
    """The ``limit`` newest arrivals, newest first."""
    return payments.orderBy(F.col(arrival).desc()).limit(max(1, limit))


def live_payments(snapshot: DataFrame, live: DataFrame, limit: int = 50) -> DataFrame:
    """Snapshot and live rows merged by payment (live wins, the later one), newest first."""
    both = snapshot.withColumn("_live", F.lit(0)).unionByName(live.withColumn("_live", F.lit(1)))
    merged = first_per_key(both, ["payment_id"], F.col("_live").desc(), F.col("arrival").desc())
    return merged.drop("_live").orderBy(F.col("occurred_at").desc(), "payment_id").limit(limit)


def recent_alerts(alerts: DataFrame, limit: int = RECENT_ALERTS, arrival: str = "seq") -> DataFrame:
    return alerts.orderBy(F.col(arrival).desc(), "alert_id").limit(limit)


def chart(mart: DataFrame, by: Sequence[str], metric: Column, name: str, rows: int | None = None) -> DataFrame:
    """Metric per group in key order; a display may ask for the first ``rows`` groups."""
    ordered = mart.groupBy(*by).agg(metric.alias(name)).orderBy(*by)
    return ordered if rows is None else ordered.limit(rows)


def chart_pivot(mart: DataFrame, index: str, series: str, metric: Column, values: Sequence[str], name: str) -> DataFrame:
    """Metric per index and series, pivoted by its mean; one column ``<name>_<value>`` per series."""
    cells = mart.groupBy(index, series).agg(metric.alias("_metric"))
    wide = cells.groupBy(index).pivot(series, list(values)).agg(F.avg("_metric"))
    return wide.select(index, *[F.col(f"`{v}`").alias(f"{name}_{v.lower()}") for v in values])


def top_rows(mart: DataFrame, by: str, *ties: str, rows: int = TABLE_ROWS) -> DataFrame:
    return mart.orderBy(F.col(by).desc(), *ties).limit(rows)


def histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Rows per equal-width bin between the least and greatest value; the last bin is closed.

    Equal values are counted first. Two numbers reach the driver: the bounds.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    low, high = counts.agg(F.min(column), F.max(column)).first()
    low, high = float(low or 0), float(high or 0)
    width = (high - low) / bins or 1.0
    place = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
    filled = counts.groupBy(place.cast("int").alias("bin")).agg(F.sum("_n").alias("rows"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(filled, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * width).alias("bin_start"),
        (F.lit(low) + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )
