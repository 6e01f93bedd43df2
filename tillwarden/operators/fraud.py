"""Fraud detection: enrichment, look-back signals, weighted score, alerts and user scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import MONEY, clamp01
from ..functions.joins import first_per_key, lookup_join
from ..functions.ordered import UNKNOWN, LookBack, hot_keys, look_back
from ..sources.schemas import DEFAULT_BASELINE_RISK, FraudRule
from .rules import RULE_FIELDS, join_spans, rule_intervals

HOUR_MS = 3_600_000

# Weights of the signals, added in this order.
W_AMOUNT = 0.35
W_VELOCITY = 0.30
W_GEO = 0.15
W_STRUCTURING = 0.45
W_BASELINE = 0.20


def geo_anomaly(merchant_id: str | Column = "merchant_id") -> Column:
    merchant = F.col(merchant_id) if isinstance(merchant_id, str) else merchant_id
    return F.coalesce(F.lower(merchant).contains(":foreign"), F.lit(False))


def amount_over_max(amount: Column, max_amount: float | Column) -> Column:
    return amount.cast("double") > max_amount


def enrich_risk(payments: DataFrame, profiles: DataFrame, hot: DataFrame | None = UNKNOWN) -> DataFrame:
    """Adds ``baseline_risk`` by account. Profiles hold one row per user and grow with the users, so
    they are broadcast only when counted small; else hot accounts are salted."""
    right = profiles.select(F.col("user_id").alias("account_id"), "baseline_risk")
    joined = lookup_join(payments, right, ["account_id"], hot=hot)
    return joined.withColumn("baseline_risk", F.coalesce("baseline_risk", F.lit(DEFAULT_BASELINE_RISK)))


def velocity(payments: DataFrame, window_ms: int, max_count: int, **tuning) -> DataFrame:
    counted = look_back(
        payments, ["account_id"], "occurred_ms", "seq", [LookBack("window_count", window_ms, F.lit(1).cast("long"))], **tuning
    )
    return counted.withColumn("velocity", F.col("window_count") > max_count)


def structuring(payments: DataFrame, threshold: float, hours: int, min_payments: int, **tuning) -> DataFrame:
    sums = _structuring_sums(F.lit(threshold), hours * HOUR_MS)
    summed = look_back(payments, ["account_id"], "occurred_ms", "seq", sums, **tuning)
    return summed.withColumn("structuring", _is_structuring(F.lit(threshold), F.lit(min_payments)))


def _structuring_sums(threshold: Column, width: int | str) -> list[LookBack]:
    """Count and sum of the payments below the threshold. Money is summed as decimal: the result does
    not depend on the order in which rows meet."""
    small = F.col("amount").cast("double") < threshold
    return [
        LookBack("small_count", width, F.when(small, 1).otherwise(0).cast("long")),
        LookBack("small_sum", width, F.when(small, F.col("amount").cast(MONEY)).otherwise(F.lit(0).cast(MONEY))),
    ]


def _is_structuring(threshold: Column, min_payments: Column) -> Column:
    return (F.col("small_count") >= min_payments) & (F.col("small_sum").cast("double") > threshold)


def score_columns(df: DataFrame) -> DataFrame:
    """Adds ``score`` and ``reasons`` from the four signals and the baseline risk."""
    raw = F.lit(0.0)
    for signal, weight in (
        ("amount_over_max", W_AMOUNT), ("velocity", W_VELOCITY), ("geo_anomaly", W_GEO), ("structuring", W_STRUCTURING)
    ):
        raw = raw + F.when(F.col(signal), weight).otherwise(0.0)
    raw = raw + F.lit(W_BASELINE) * clamp01("baseline_risk")
    names = ("amount_over_max", "velocity", "geo_anomaly", "structuring")
    reasons = F.array_compact(F.array(*[F.when(F.col(n), F.lit(n)) for n in names]))
    return df.withColumn("score", clamp01(raw)).withColumn("reasons", reasons)


def detect(payments: DataFrame, rule: FraudRule, profiles: DataFrame, keep: Column | None = None, **tuning) -> DataFrame:
    """Scores every payment under one rule.

    ``keep`` selects the rows to score; the other rows only fill the look-back windows. Velocity and
    structuring share one sweep, so payments are shuffled once.
    """
    sums = [
        LookBack("window_count", rule.velocity_window_ms, F.lit(1).cast("long")),
        *_structuring_sums(F.lit(rule.structuring_threshold), rule.structuring_window_hours * HOUR_MS),
    ]
    swept = look_back(payments, ["account_id"], "occurred_ms", "seq", sums, keep=keep, **tuning)
    signals = swept.withColumns(
        {
            "amount_over_max": amount_over_max(F.col("amount"), F.lit(rule.max_amount)),
            "velocity": F.col("window_count") > rule.velocity_max_count,
            "geo_anomaly": geo_anomaly(),
            "structuring": _is_structuring(F.lit(rule.structuring_threshold), F.lit(rule.structuring_min_payments)),
            "rule_id": F.lit(rule.rule_id),
            "rule_version": F.lit(rule.version),
        }
    )
    return score_columns(enrich_risk(signals, profiles, hot_keys(payments, ["account_id"], tuning.get("limit"))))


def detect_asof(payments: DataFrame, rules: DataFrame, profiles: DataFrame, **tuning) -> DataFrame:
    """Scores every payment under the rule in force at its event time.

    A rule also sees the payments before its span that its windows look back on, so the sweep is keyed
    by (account, rule) and each payment is copied only to the rules that can see it.
    """
    spans = (
        rule_intervals(rules)
        .withColumn("structuring_ms", F.col("structuring_window_hours") * HOUR_MS)
        .withColumn("_reach", F.greatest("velocity_window_ms", "structuring_ms"))
    )
    seen = join_spans(payments, spans, F.col("from_ms") - F.col("_reach"), F.col("to_ms")).drop("_reach")
    sums = [
        LookBack("window_count", "velocity_window_ms", F.lit(1).cast("long")),
        *_structuring_sums(F.col("structuring_threshold"), "structuring_ms"),
    ]
    own = F.col("from_ms").isNull() | (F.col("occurred_ms") >= F.col("from_ms"))
    swept = look_back(seen, ["account_id", "rule_seq"], "occurred_ms", "seq", sums, keep=own, **tuning)
    return score_counted(swept, profiles, hot_keys(payments, ["account_id"], tuning.get("limit"))).drop("from_ms", "to_ms", "structuring_ms", "rule_seq")


def score_counted(counted: DataFrame, profiles: DataFrame, hot: DataFrame | None = UNKNOWN) -> DataFrame:
    """Scores payments that have their window counts and the fields of their rule beside them."""
    signals = counted.withColumns(
        {
            "amount_over_max": amount_over_max(F.col("amount"), F.col("max_amount")),
            "velocity": F.col("window_count") > F.col("velocity_max_count"),
            "geo_anomaly": geo_anomaly(),
            "structuring": _is_structuring(F.col("structuring_threshold"), F.col("structuring_min_payments")),
            "rule_version": F.col("version"),
        }
    )
    keep = [c for c in signals.columns if c not in RULE_FIELDS or c == "rule_id"]
    return score_columns(enrich_risk(signals.select(*keep), profiles, hot))


def fraud_alerts(scored: DataFrame) -> DataFrame:
    """Alerts of the payments with a reason. The id is a hash, so a replay repeats it."""
    alert_id = F.md5(F.concat_ws("|", "event_id", "rule_id", F.col("rule_version").cast("string")))
    return scored.filter(F.size("reasons") > 0).select(
        alert_id.alias("alert_id"),
        F.col("account_id").alias("user_id"),
        "payment_id",
        "score",
        "reasons",
        "rule_id",
        "occurred_ms",
        F.timestamp_millis("occurred_ms").alias("occurred_at"),
        F.to_date(F.timestamp_millis("occurred_ms")).alias("alert_date"),
    )


def user_scores(scored: DataFrame) -> DataFrame:
    """One score row per payment, with the order columns that make the newest one well defined."""
    return scored.select(
        F.col("account_id").alias("user_id"),
        "score",
        F.col("payment_id").alias("last_payment_id"),
        F.col("occurred_ms").alias("updated_at"),
        "seq",
    )


def latest_scores(scores: DataFrame) -> DataFrame:
    """Compacted scores: the last one written per user."""
    return first_per_key(scores, ["user_id"], F.col("seq").desc()).drop("seq")


def participant_fraud_score(amount: Column) -> Column:
    """Fixed values of the lifecycle's own fraud check."""
    return F.when(amount > 1000, 0.9).otherwise(0.05)
