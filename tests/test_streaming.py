"""Streaming jobs over several micro-batches against their batch twins."""

import pytest
from pyspark.sql import functions as F

from tillwarden.operators import fraud, landing, ledger, lifecycle, monitoring, parsing
from tillwarden.session import shared_dir
from tillwarden.sources import samples as S
from tillwarden.sources.schemas import DEFAULT_RULE, FraudRule
from tillwarden.sources.topics import file_stream
from tillwarden.streaming import jobs

TIGHT = FraudRule("rule-tight", 1, True, 10000.0, 6 * fraud.HOUR_MS, 2)


@pytest.fixture(scope="module")
def topic(spark, data):
    """The raw topic in three files, in order of arrival."""
    folder = shared_dir(spark, "topic")
    raw = S.raw_payments(spark, data)
    for low, high in ((0, 300), (300, 650), (650, 10**9)):
        part = raw.filter((F.col("offset") >= low) & (F.col("offset") < high)).orderBy("offset")
        part.coalesce(1).write.mode("append").parquet(folder)
    return folder


def _stream(spark, topic):
    return file_stream(spark, topic, files_per_batch=1)


def _set(df, *columns):
    return sorted(tuple(map(repr, r)) for r in df.select(*columns).collect())


def test_detection_equals_batch(spark, data, topic):
    profiles = S.profiles(spark, data)
    root = shared_dir(spark, "detect")
    jobs.detect(_stream(spark, topic), root, lambda: TIGHT, lambda: profiles).awaitTermination()
    parsed = parsing.parse_payments(spark.read.parquet(topic))
    good = parsing.valid_payments(parsed).withColumn("seq", F.col("offset"))
    scored = fraud.detect(good, TIGHT, profiles)
    columns = ["alert_id", "user_id", "payment_id", "score", "reasons", "rule_id", "occurred_ms"]
    alerts = jobs.read_batches(spark, root, "alerts")
    assert _set(alerts, *columns) == _set(fraud.fraud_alerts(scored), *columns)
    assert alerts.filter(F.array_contains("reasons", "velocity")).count() > 0
    scores = fraud.latest_scores(jobs.read_batches(spark, root, "scores"))
    names = ["user_id", "score", "last_payment_id", "updated_at"]
    assert _set(scores, *names) == _set(fraud.latest_scores(fraud.user_scores(scored)), *names)
    letters = jobs.read_batches(spark, root, "dead_letters")
    assert _set(letters, "raw", "error") == _set(parsing.dead_letters(parsed), "raw", "error")
    assert len(spark.read.parquet(f"{root}/alerts").select("batch_id").distinct().collect()) == 3


def test_rule_change_acts_on_the_next_batch(spark, data, topic):
    used = []

    def rule():
        used.append(DEFAULT_RULE if not used else TIGHT)
        return used[-1]

    root = shared_dir(spark, "reload")
    jobs.detect(_stream(spark, topic), root, rule, lambda: S.profiles(spark, data)).awaitTermination()
    by_batch = spark.read.parquet(f"{root}/alerts").groupBy("batch_id").agg(F.collect_set("rule_id").alias("r")).collect()
    assert {r.batch_id: r.r for r in by_batch} == {0: ["rule-default"], 1: ["rule-tight"], 2: ["rule-tight"]}
    # The new, wider window is filled from history that the old rule did not need.
    good = parsing.valid_payments(parsing.parse_payments(spark.read.parquet(topic))).withColumn("seq", F.col("offset"))
    want = fraud.fraud_alerts(fraud.detect(good, TIGHT, S.profiles(spark, data), keep=F.col("seq") >= 300))
    got = jobs.read_batches(spark, root, "alerts").filter("rule_id = 'rule-tight'")
    assert _set(got, "alert_id", "reasons") == _set(want, "alert_id", "reasons")


def test_replayed_batch_leaves_the_same_rows(spark, data, topic):
    """The last batch is taken from the commit log, as after a crash, and runs again."""
    import os

    root = shared_dir(spark, "again")
    profiles, sent = S.profiles(spark, data), []

    def run():
        jobs.detect(
            _stream(spark, topic), root, lambda: TIGHT, lambda: profiles, publish=lambda name, df: sent.append((name, df.count()))
        ).awaitTermination()
        return sorted(r.alert_id for r in jobs.read_batches(spark, root, "alerts").select("alert_id").collect())

    first = run()
    commits = f"{root}/_checkpoints/detect/commits"
    for name in os.listdir(commits):
        if name.strip(".").split(".")[0] == "2":
            os.remove(f"{commits}/{name}")
    assert run() == first
    assert [n for n, _ in sent].count("fraud_alerts") == 4 and sent[-3:] == sent[-6:-3]


@pytest.mark.parametrize("merge_every", [2, 16])
def test_balances_with_copies_in_other_batches(spark, data, monkeypatch, merge_every):
    monkeypatch.setattr(jobs, "MERGE_EVERY", merge_every)
    folder = shared_dir(spark, "arrivals")
    arrivals = S.payment_arrivals(spark, data).drop("k", "occurred_ms")
    third = F.col("seq") < 400
    first = arrivals.filter(third & (F.col("arrival") < 10**11))
    second = arrivals.filter(~third & (F.col("arrival") < 10**11))
    copies = arrivals.filter(F.col("arrival") >= 10**11)
    for part in (first, second, copies):
        part.coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(arrivals.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    root = shared_dir(spark, "balances")
    jobs.balances(stream, root).awaitTermination()
    unique = landing.dedup_first(arrivals, ["event_id"])
    names = ["account_id", "currency", "balance", "last_occurred_at"]
    assert _set(jobs.current_balances(spark, root), *names) == _set(ledger.account_balance(unique), *names)
    events = jobs.read_batches(spark, root, "balance_events")
    assert events.count() == unique.count()
    last = events.groupBy("account_id", "currency").agg(F.max_by("balance_after", "arrival").alias("balance"))
    assert _set(last, "account_id", "currency", "balance") == _set(ledger.account_balance(unique), "account_id", "currency", "balance")


def test_hourly_metrics_of_closed_hours(spark, data):
    folder = shared_dir(spark, "hours")
    payments = S.payments(spark, data)
    for low, high in ((0, 500), (500, 10**9)):
        payments.filter((F.col("seq") >= low) & (F.col("seq") < high)).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(payments.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    root = shared_dir(spark, "hourly")
    jobs.hourly_metrics(stream, root).awaitTermination()
    limit = payments.agg(F.max("occurred_at")).first()[0]
    twin = monitoring.hourly_metrics(payments).filter(F.col("window_end") <= F.lit(limit) - F.expr("INTERVAL 5 SECONDS"))
    names = ["window_start", "window_end", "currency", "payment_count", "total_amount"]
    assert _set(spark.read.parquet(f"{root}/hourly_metrics"), *names) == _set(twin, *names)


def test_landing_and_outcomes(spark, data, topic):
    root = shared_dir(spark, "landing")
    jobs.land(_stream(spark, topic), root).awaitTermination()
    landed = spark.read.parquet(f"{root}/payment_events")
    batch = landing.land_payments(landing.read_payment_topic(spark.read.parquet(topic)))
    assert _set(landed, "event_id", "account_id", "occurred_at") == _set(batch, "event_id", "account_id", "occurred_at")
    events = S.saga_events(spark, data)
    folder = shared_dir(spark, "events")
    for flag in (True, False):
        events.filter((F.col("seq") % 20 < 10) == flag).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    jobs.saga_outcomes(stream, root).awaitTermination()
    assert _set(jobs.newest_batch(spark, root, "saga_outcomes"), "outcome", "sagas") == _set(lifecycle.saga_outcomes(events), "outcome", "sagas")


def test_a_batch_reads_only_the_days_it_reaches(spark, data):
    """A record of long ago adds its own days, and history between is not read."""
    folder = shared_dir(spark, "days")
    base = S.payments(spark, data).filter("seq < 300")
    day = F.expr("INTERVAL 1 DAY")
    for k in range(5):
        shifted = base.withColumn("occurred_at", F.col("occurred_at") + k * 40 * day)
        if k == 4:
            old = base.filter("seq = 7").withColumn("occurred_at", F.lit("1970-01-05 00:00:00").cast("timestamp"))
            shifted = shifted.filter("seq <> 7").unionByName(old)
        S.raw_payment_records(shifted.withColumn("seq", F.col("seq") + 1000 * k)).coalesce(1).write.mode("append").parquet(folder)
    root = shared_dir(spark, "detect")
    jobs.detect(_stream(spark, folder), root, lambda: TIGHT, lambda: S.profiles(spark, data)).awaitTermination()
    alerts = spark.read.parquet(f"{root}/scores")
    assert alerts.filter("batch_id = 4").count() == alerts.filter("batch_id = 3").count()
    history = spark.read.schema(jobs.HISTORY).parquet(f"{root}/history")
    reached = history.filter("batch_id = 4").select(F.explode(F.sequence(F.col("day") - 1, F.col("day"))).alias("day")).distinct()
    assert history.filter("batch_id < 4").join(reached, "day", "left_semi").count() < 0.3 * history.filter("batch_id < 4").count()
