"""Rule configuration: compacted logs, the active rule, as-of rules and the rule registry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import first_per_key, lookup_join
from ..sources.schemas import DEFAULT_RULE, FRAUD_RULE, FraudRule

RULE_FIELDS = [f.name for f in FRAUD_RULE]
BUCKET_MS = 30 * 24 * 3_600_000
#: Most copies of a span in a join by time buckets.
BUCKETS = 1000


def compact_latest(log: DataFrame, keys: Sequence[str], offset: str = "offset") -> DataFrame:
    """Newest record per key of a changelog topic."""
    return first_per_key(log, keys, F.col(offset).desc())


def active_rule(log: DataFrame) -> FraudRule:
    """The last record written, whatever its id; a disabled one gives way to the built-in rule.

    One row reaches the driver, so its values become literals of the plan.
    """
    last = log.agg(F.max_by(F.struct(*RULE_FIELDS), "offset").alias("r")).select("r.*").first()
    if last is None or last["rule_id"] is None or not last["enabled"]:
        return DEFAULT_RULE
    return FraudRule(**last.asDict())


def active_rule_table(log: DataFrame) -> DataFrame:
    """The same as a one-row table."""
    last = log.agg(F.max_by(F.struct(*RULE_FIELDS), "offset").alias("r"))
    return last.select(*_effective(F.col("r")))


def _effective(rule: Column) -> list[Column]:
    on = F.coalesce(rule["enabled"], F.lit(False))
    return [
        F.when(on, rule[f]).otherwise(F.lit(getattr(DEFAULT_RULE, f)).cast(FRAUD_RULE[f].dataType)).alias(f)
        for f in RULE_FIELDS
    ]


def rule_intervals(log: DataFrame) -> DataFrame:
    """Rules with the time span ``[from_ms, to_ms)`` in which each is in force; NULL is an open end.

    A record without ``valid_from`` holds from its ingest time on. The log holds hand-made configuration changes,
    so ordering it in one task is no concern. A span before the first record belongs to the built-in rule.
    """
    start = F.col("valid_from") if "valid_from" in log.columns else F.lit(None).cast("timestamp")
    if "ingest_ts" in log.columns:
        start = F.coalesce(start, F.col("ingest_ts"))
    log = log.withColumn("_start", F.unix_millis(start)).filter(F.col("_start").isNotNull())
    order = Window.orderBy("_start", "offset")
    spans = log.select(
        *_effective(F.struct(*RULE_FIELDS)),
        F.col("offset").alias("rule_seq"),
        F.col("_start").alias("from_ms"),
        F.lead("_start").over(order).alias("to_ms"),
    )
    before = log.agg(F.min("_start").alias("to_ms")).select(
        *[F.lit(getattr(DEFAULT_RULE, f)).cast(FRAUD_RULE[f].dataType).alias(f) for f in RULE_FIELDS],
        F.lit(-1).cast("long").alias("rule_seq"),
        F.lit(None).cast("long").alias("from_ms"),
        "to_ms",
    )
    # records of one instant: only the last one's span is not empty
    return spans.unionByName(before).filter(F.coalesce(F.col("from_ms") < F.col("to_ms"), F.lit(True)))


def join_spans(payments: DataFrame, spans: DataFrame, since: Column, until: Column) -> DataFrame:
    """Payments with every span that covers them: an equi join on time buckets, then the exact test.

    Buckets reach from the first to the last end of any span. Payments before or after belong to the outermost
    ones, and so do open spans (NULL ends): they are cut to this range, so a span has at most ``BUCKETS`` copies.
    """
    marked = spans.withColumn("_since", since).withColumn("_until", until)
    ends = F.least(F.min("_since"), F.min("_until")), F.greatest(F.max("_since"), F.max("_until"))
    low, high = marked.agg(*ends).first()  # two numbers
    low, high = (0, 0) if low is None else (low, high)
    width = max(BUCKET_MS, -(-(high - low + 1) // BUCKETS))

    def bucket(at: Column) -> Column:
        return F.floor((F.least(F.greatest(at, F.lit(low)), F.lit(high)) - low) / width)

    first, last = bucket(F.coalesce("_since", F.lit(low))), bucket(F.coalesce("_until", F.lit(high)))
    bucketed = marked.withColumn("_bucket", F.explode(F.sequence(first, last)))
    left = payments.withColumn("_bucket", bucket(F.col("occurred_ms")))
    joined = lookup_join(left, bucketed, ["_bucket"], "inner")
    at = F.col("occurred_ms")
    inside = (F.col("_since").isNull() | (at >= F.col("_since"))) & (F.col("_until").isNull() | (at < F.col("_until")))
    return joined.filter(inside).drop("_bucket", "_since", "_until")


def rule_asof(payments: DataFrame, log: DataFrame) -> DataFrame:
    """Payments with the rule in force at their event time."""
    joined = join_spans(payments, rule_intervals(log), F.col("from_ms"), F.col("to_ms"))
    return joined.drop("from_ms", "to_ms", "rule_seq")


def rule_latest_version(acks: DataFrame) -> DataFrame:
    return acks.groupBy("rule_id").agg(F.max("version").alias("version"))


def rule_acks_since(acks: DataFrame, rule_id: str | None = None, since: int = 0) -> DataFrame:
    """Applied versions at or above ``since``. With a rule id the latest applied one leads, marked
    ``already_applied``, followed by its live acknowledgements."""
    live = acks.filter(F.col("version") >= since).select("rule_id", "version", F.lit(False).alias("already_applied"))
    if rule_id is None:
        return live
    current = rule_latest_version(acks.filter(F.col("rule_id") == rule_id)).filter(F.col("version") >= since)
    return current.withColumn("already_applied", F.lit(True)).unionByName(live.filter(F.col("rule_id") == rule_id))


def rule_versions(changes: DataFrame) -> DataFrame:
    """Version per change of a rule (``create``, ``update``, ``delete`` in ``seq`` order).

    A deletion keeps the version it found and publishes the rule as disabled.
    """
    order = Window.partitionBy("id").orderBy("seq")
    bumps = F.sum(F.when(F.col("action") == "delete", 0).otherwise(1)).over(order)
    return changes.withColumn("version", bumps.cast("long")).withColumn(
        "enabled", F.when(F.col("action") == "delete", False).otherwise(F.col("enabled"))
    )


def rule_registry(changes: DataFrame) -> DataFrame:
    """Rules that still exist, newest state per id."""
    latest = first_per_key(rule_versions(changes), ["id"], F.col("seq").desc())
    return latest.filter(F.col("action") != "delete").select(
        "id", "name", "enabled", "json_spec", "version", F.col("changed_at").alias("updated_at")
    )


def rules_list(registry: DataFrame) -> DataFrame:
    return registry.orderBy("name")


def rule_payload(versions: DataFrame) -> DataFrame:
    """Published form of a rule: its spec with ruleId, version and enabled put in.

    The spec is an object of any shape, so the fields are merged as a map of JSON values. A spec that is no JSON
    object has no payload but an ``error``, so that it is not published.
    """
    # to_json of a map<string, variant> keeps numbers as numbers and nested values as they are.
    spec = F.from_json("json_spec", "map<string, variant>")
    own = F.from_json(
        F.to_json(F.struct(F.col("id").alias("ruleId"), "version", "enabled")), "map<string, variant>"
    )
    reserved = F.array(F.lit("ruleId"), F.lit("version"), F.lit("enabled"))
    kept = F.map_filter(spec, lambda k, _: ~F.array_contains(reserved, k))
    good = F.coalesce(~F.is_variant_null(F.try_parse_json("json_spec")), F.lit(False)) & spec.isNotNull()
    return versions.select(
        "id",
        "version",
        F.col("id").alias("key"),
        F.when(good, F.to_json(F.map_concat(kept, own))).alias("payload"),
        F.when(~good, "invalid rule spec").alias("error"),
    )
