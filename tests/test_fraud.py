from pyspark.sql import functions as F

from tillwarden.operators import fraud, rules
from tillwarden.sources.schemas import DEFAULT_RULE, FraudRule

PAYMENT = "event_id string, payment_id string, account_id string, amount double, currency string, merchant_id string, occurred_ms long, seq long"
BASE = 1_700_000_000_000


def _burst(spark, n=4, amount=9000.0, step=1000, merchant="m1"):
    rows = [
        (f"e{i}", f"p{i}", "acc-1", amount + 100 * (i - 1), "USD", merchant, BASE + step * i, i) for i in range(1, n + 1)
    ]
    return spark.createDataFrame(rows, PAYMENT)


def _profiles(spark, risk=0.1):
    return spark.createDataFrame([("acc-1", risk)], "user_id string, baseline_risk double")


def test_structuring_burst(spark):
    alerts = fraud.fraud_alerts(fraud.detect(_burst(spark), DEFAULT_RULE, _profiles(spark)))
    found = {r.payment_id: r.reasons for r in alerts.collect()}
    assert found == {"p3": ["structuring"], "p4": ["structuring"]}


def test_structuring_needs_small_payments(spark):
    one = fraud.structuring(_burst(spark, 1, 15000.0), 9900.0, 24, 3).first()
    assert not one.structuring
    four = fraud.structuring(_burst(spark, 4, 9000.0), 9900.0, 24, 3).filter("seq = 4").first()
    assert four.structuring and four.small_count == 4


def test_geo(spark):
    df = spark.createDataFrame([("merchant-xyz:foreign",), ("merchant-xyz",), (None,), ("M:FOREIGN",)], "merchant_id string")
    assert [r[0] for r in df.select(fraud.geo_anomaly()).collect()] == [True, False, False, True]


def test_velocity_window_is_closed_and_strict(spark):
    now = 10_000_000
    rows = [(f"e{i}", f"p{i}", "a", 1.0, "USD", None, t, i) for i, t in enumerate([now - 4_000_000, now - 3_600_000, now - 50, now])]
    counted = fraud.velocity(spark.createDataFrame(rows, PAYMENT), 3_600_000, 2).filter("seq = 3").first()
    assert counted.window_count == 3 and counted.velocity
    assert not fraud.velocity(spark.createDataFrame(rows, PAYMENT), 3_600_000, 3).filter("velocity").count()


def test_score_all_and_none(spark):
    cols = "amount_over_max boolean, velocity boolean, geo_anomaly boolean, structuring boolean, baseline_risk double"
    df = spark.createDataFrame([(True, True, True, True, 1.0), (False, False, False, False, 0.1), (False,) * 4 + (7.0,)], cols)
    full, none, clamped = fraud.score_columns(df).collect()
    assert full.score == 1.0 and full.reasons == ["amount_over_max", "velocity", "geo_anomaly", "structuring"]
    assert none.score < 0.05 and none.reasons == []
    assert clamped.score == 0.2


def test_missing_profile_gets_default(spark):
    other = spark.createDataFrame([("acc-2", 0.9)], "user_id string, baseline_risk double")
    assert {r.baseline_risk for r in fraud.enrich_risk(_burst(spark), other).collect()} == {0.1}


def test_alert_ids_repeat(spark):
    def ids():
        alerts = fraud.fraud_alerts(fraud.detect(_burst(spark), DEFAULT_RULE, _profiles(spark)))
        return sorted(r.alert_id for r in alerts.collect())

    assert ids() == ids()


RULE_LOG = (
    "offset long, rule_id string, version long, enabled boolean, max_amount double, velocity_window_ms long, velocity_max_count long,"
    " structuring_threshold double, structuring_window_hours long, structuring_min_payments long, valid_from timestamp"
)


def _log(spark, *rows):
    import datetime

    full = [
        (i, rid, v, on, mx, 1000, 1, 9900.0, 24, 3, datetime.datetime.fromtimestamp(at / 1000, datetime.timezone.utc))
        for i, (rid, v, on, mx, at) in enumerate(rows)
    ]
    return spark.createDataFrame(full, RULE_LOG)


def test_active_rule_is_last_record(spark):
    assert rules.active_rule(_log(spark, ("r1", 1, True, 5.0, BASE), ("r2", 4, True, 6.0, BASE))).rule_id == "r2"
    assert rules.active_rule(_log(spark, ("r1", 1, True, 5.0, BASE), ("r2", 4, False, 6.0, BASE))) == DEFAULT_RULE
    assert rules.active_rule_table(_log(spark, ("r2", 4, False, 6.0, BASE))).first().rule_id == "rule-default"


def test_detect_asof_equals_detect_inside_a_span(spark):
    """A rule in force all the time scores like a fixed rule; before it the built-in one holds."""
    log = _log(spark, ("r1", 2, True, 9050.0, BASE + 2000))
    got = {r.seq: (r.rule_id, r.amount_over_max, r.window_count) for r in fraud.detect_asof(_burst(spark), log, _profiles(spark)).collect()}
    assert got[1][0] == "rule-default" and got[2] == ("r1", True, 2)
    rule = FraudRule("r1", 2, True, 9050.0, 1000, 1)
    fixed = {r.seq: r.window_count for r in fraud.detect(_burst(spark), rule, _profiles(spark)).collect()}
    assert {s: got[s][2] for s in (2, 3, 4)} == {s: fixed[s] for s in (2, 3, 4)}


def test_keep_scores_only_wanted_rows(spark):
    kept = fraud.detect(_burst(spark), DEFAULT_RULE, _profiles(spark), keep=F.col("seq") == 4).collect()
    assert [(r.seq, r.structuring) for r in kept] == [(4, True)]


def test_payments_far_from_any_rule_are_scored(spark):
    log = _log(spark, ("r1", 2, True, 9050.0, BASE + 2000))
    far = _burst(spark).select(*[F.col(c) for c in _burst(spark).columns if c != "occurred_ms"], F.lit(-86_400_000).cast("long").alias("occurred_ms"))
    late = far.withColumn("occurred_ms", F.lit(9_999_999_999_999).cast("long"))
    both = far.unionByName(late).unionByName(_burst(spark))
    scored = fraud.detect_asof(both, log, _profiles(spark))
    assert scored.count() == both.count() == fraud.detect(both, DEFAULT_RULE, _profiles(spark)).count()
    assert {r.rule_id for r in scored.filter("occurred_ms < 0").collect()} == {"rule-default"}
    assert {r.rule_id for r in scored.filter("occurred_ms > 4e12").collect()} == {"r1"}
    assert rules.rule_asof(both, log.limit(0)).count() == both.count()


def test_rule_without_start_holds_from_its_ingest_time(spark):
    log = _log(spark, ("r1", 2, True, 9050.0, BASE + 2000))
    ingested = log.withColumnRenamed("valid_from", "ingest_ts")
    assert sorted(map(tuple, rules.rule_intervals(ingested).collect())) == sorted(map(tuple, rules.rule_intervals(log).collect()))
