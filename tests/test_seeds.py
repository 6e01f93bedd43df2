from pyspark.sql import functions as F

from tillwarden.operators import parsing, rules
from tillwarden.sources import seeds
from tillwarden.sources.schemas import DEFAULT_RULE


def _now():
    return F.lit("2026-01-01 00:00:00").cast("timestamp")


def test_seeded_rule_is_the_built_in_one(spark):
    log = parsing.parse_rules(seeds.rule_seeds(spark, _now()))
    assert rules.active_rule(log) == DEFAULT_RULE


def test_seeded_profiles(spark):
    found = parsing.parse_profiles(seeds.profile_seeds(spark, _now()))
    assert {r.user_id: r.baseline_risk for r in found.collect()} == {"acc-1": 0.1, "acc-2": 0.2}


def test_registry_row_is_put_in_once(spark):
    none = spark.createDataFrame([], "name string")
    first = seeds.registry_seeds(spark, none, _now())
    assert [r.name for r in first.collect()] == ["default-velocity"]
    assert seeds.registry_seeds(spark, first, _now()).count() == 0
