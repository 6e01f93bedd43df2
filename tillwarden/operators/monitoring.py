"""Rates, lags and alarms over business streams, evaluated on a fixed grid of instants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import MONEY

MINUTE = 60
DAY_MINUTES = 1440


def hourly_metrics(payments: DataFrame, amount: Column | None = None) -> DataFrame:
    """Count and total per currency and event-time hour. Partial sums form before the shuffle, so a
    handful of currencies is no bottleneck."""
    # decimals, so that a total does not depend on the order of its rows
    total = F.sum((amount if amount is not None else F.col("amount")).cast(MONEY))
    return (
        payments.groupBy(F.window("occurred_at", "1 hour").alias("w"), "currency")
        .agg(F.count(F.lit(1)).alias("payment_count"), total.alias("total_amount"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            F.to_date("w.start").alias("metric_date"),
            "currency",
            "payment_count",
            "total_amount",
        )
    )


def rate(events: DataFrame, time: str, keys: Sequence[str], window_seconds: int, step_seconds: int = MINUTE) -> DataFrame:
    """Events per second over ``[at - window, at)`` at every grid instant with one in it.

    Events are counted per step first; only those counts are copied to the instants that see them.
    ``window_seconds`` is a multiple of ``step_seconds``.
    """
    steps = window_seconds // step_seconds
    slot = F.floor(F.unix_seconds(time) / step_seconds)
    counts = events.groupBy(*keys, slot.alias("_slot")).agg(F.count(F.lit(1)).alias("_n"))
    seen = counts.withColumn("_at", F.explode(F.sequence(F.col("_slot") + 1, F.col("_slot") + steps)))
    return (
        seen.groupBy(*keys, "_at")
        .agg(F.sum("_n").alias("events"))
        .select(
            *keys,
            F.timestamp_seconds(F.col("_at") * step_seconds).alias("at"),
            "events",
            (F.col("events") / window_seconds).alias("per_second"),
        )
    )


def _spans(series: DataFrame, per_day: int) -> DataFrame:
    """Runs of consecutive slots (``_from``, ``_to``) of a series of distinct ``_slot``.

    Runs are found day by day; only those that touch a day's end, two a day at most, are joined in one task.
    """
    own = Window.partitionBy("_day").orderBy("_slot")
    runs = (
        series.withColumn("_day", F.floor(F.col("_slot") / per_day))
        .withColumn("_island", F.col("_slot") - F.row_number().over(own))
        .groupBy("_day", "_island")
        .agg(F.min("_slot").alias("_from"), F.max("_slot").alias("_to"))
    )
    at_edge = (F.col("_from") % per_day == 0) | (F.col("_to") % per_day == per_day - 1)
    order = Window.orderBy("_from")
    apart = F.coalesce((F.col("_from") != F.lag("_to").over(order) + 1).cast("int"), F.lit(1))
    edges = runs.filter(at_edge).withColumn("_apart", apart).withColumn("_run", F.sum("_apart").over(order))
    joined = edges.groupBy("_run").agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"))
    return runs.filter(~at_edge).select("_from", "_to").unionByName(joined.select("_from", "_to"))


def sustained(points: DataFrame, hold_seconds: int, step_seconds: int = MINUTE) -> DataFrame:
    """Spans of consecutive true grid instants (column ``at``) that last ``hold_seconds`` or longer."""
    slot = F.floor(F.unix_seconds("at") / step_seconds)
    spans = _spans(points.select(slot.alias("_slot")).distinct(), 86_400 // step_seconds)
    held = hold_seconds // step_seconds
    return spans.filter(F.col("_to") - F.col("_from") >= held).select(
        F.timestamp_seconds(F.col("_from") * step_seconds).alias("pending_since"),
        F.timestamp_seconds((F.col("_from") + held) * step_seconds).alias("fired_at"),
        F.timestamp_seconds(F.col("_to") * step_seconds).alias("last_true_at"),
    )


def alarm_rate(events: DataFrame, time: str, threshold: float, window_seconds: int = 300, hold_seconds: int = 300) -> DataFrame:
    """Spans in which the rate of ``events`` stayed above ``threshold`` per second."""
    series = rate(events, time, [], window_seconds).filter(F.col("per_second") > threshold)
    return sustained(series, hold_seconds)


# Thresholds of the alarms (per second, or seconds of lag).
HIGH_FRAUD_RATE = 0.05
COMPENSATION_RATE = 0.1
OUTBOX_LAG_SECONDS = 30


def alarm_high_fraud(alerts: DataFrame, threshold: float = HIGH_FRAUD_RATE) -> DataFrame:
    return alarm_rate(alerts, "occurred_at", threshold)


def alarm_compensation(saga_events: DataFrame, threshold: float = COMPENSATION_RATE) -> DataFrame:
    return alarm_rate(saga_events.filter(F.col("event_type") == "SAGA_COMPENSATED"), "occurred_at", threshold)


def projection_lag(balances: DataFrame, as_of: Column) -> DataFrame:
    return balances.agg(_lag(F.max("last_occurred_at"), as_of).alias("lag_seconds"))


def outbox_lag(outbox: DataFrame, as_of: Column) -> DataFrame:
    return outbox.agg(_lag(F.max("created_at"), as_of).alias("lag_seconds"))


def _lag(newest: Column, as_of: Column) -> Column:
    seconds = (F.unix_millis(as_of) - F.unix_millis(newest)) / 1000
    return F.greatest(F.lit(0.0), F.coalesce(seconds, F.lit(0.0)))


def alarm_outbox_lag(outbox: DataFrame, as_of: Column, lag_seconds: int = OUTBOX_LAG_SECONDS, hold_seconds: int = 300) -> DataFrame:
    """Spans in which the newest outbox row stayed older than ``lag_seconds`` at every full minute.

    A minute is quiet exactly when some row was created in the ``lag_seconds`` before it, so the spans
    are the gaps between quiet minutes; a grid of all minutes is not needed.
    """
    micros = F.unix_micros("created_at")
    minute = F.ceil(micros / (MINUTE * 1_000_000))
    quiet = outbox.filter(minute * MINUTE * 1_000_000 - micros <= lag_seconds * 1_000_000).select(minute.alias("_m"))
    # The first row ever starts the series: before it the lag is zero.
    first = outbox.agg((F.ceil(F.min(micros) / (MINUTE * 1_000_000)) - 1).alias("_m")).filter(F.col("_m").isNotNull())
    end = F.floor(F.unix_seconds(as_of) / MINUTE) + 1
    points = quiet.unionByName(first).distinct().filter(F.col("_m") < end)
    # the next quiet minute of the same day, or the first one of the next day that has any
    days = points.groupBy(F.floor(F.col("_m") / DAY_MINUTES).alias("_day")).agg(F.min("_m").alias("_first"))
    later = days.select("_day", F.lead("_first").over(Window.orderBy("_day")).alias("_later"))
    dated = points.withColumn("_day", F.floor(F.col("_m") / DAY_MINUTES)).join(later, "_day")
    own = Window.partitionBy("_day").orderBy("_m")
    following = F.coalesce(F.lead("_m").over(own), F.col("_later"), end)
    held = hold_seconds // MINUTE
    spans = dated.select((F.col("_m") + 1).alias("_from"), (following - 1).alias("_to"))
    return spans.filter(F.col("_to") - F.col("_from") >= held).select(
        F.timestamp_seconds(F.col("_from") * MINUTE).alias("pending_since"),
        F.timestamp_seconds((F.col("_from") + held) * MINUTE).alias("fired_at"),
        F.timestamp_seconds(F.col("_to") * MINUTE).alias("last_true_at"),
    )
