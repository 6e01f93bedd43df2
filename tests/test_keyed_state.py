"""Streams with keyed state: replay of lifecycles, timers of steps, look-back windows."""

import datetime
import hashlib
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_lifecycle import LOG, _random_log

from tillwarden.operators import fraud, monitoring, parsing, replay
from tillwarden.session import shared_dir
from tillwarden.sources import samples as S
from tillwarden.sources.schemas import DEFAULT_RULE, FraudRule
from tillwarden.sources.topics import file_stream
from tillwarden.streaming import alarms, jobs, late, lookback, requests, sagas


def _set(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_replay_over_batches_and_restarts(spark):
    rng = random.Random(3)
    rows = [(r[0], 3 * r[1] + "abc".index(r[0]), *r[2:]) for n, many in (("a", 60), ("b", 20), ("c", 2)) for r in _random_log(rng, n, many)]
    rows.sort(key=lambda r: r[1])
    source, root = shared_dir(spark, "log"), shared_dir(spark, "out")
    # The third delivery repeats rows of the second.
    for part in (rows[:30], rows[30:55], rows[50:]):
        spark.createDataFrame(part[::-1], LOG).coalesce(1).write.mode("append").parquet(source)
        sagas.replay(spark.readStream.schema(LOG).parquet(source), root).awaitTermination()
    records = jobs.read_batches(spark, root, "saga_replay")
    done = replay.replay(spark.createDataFrame(rows, LOG))
    assert _set(replay.lifecycle_events(records)) == _set(replay.lifecycle_events(done))
    newest = sagas.newest_states(records)
    assert _set(replay.step_states(newest)) == _set(replay.step_states(done))
    assert _set(replay.saga_states(newest)) == _set(replay.saga_states(done))


EVENT = "saga_id string, step_name string, kind string, at timestamp"


def test_step_timers(spark):
    """A reply takes a timer off, a clock lets the others fire, a retryable step is armed again up to its limit."""
    t0 = datetime.datetime(2026, 1, 1)

    def at(seconds):
        return t0 + datetime.timedelta(seconds=seconds)

    folder, root = shared_dir(spark, "events"), shared_dir(spark, "timeouts")
    batches = [
        [("a", "FRAUD_CHECK", "s", at(0)), ("b", "LEDGER_APPLY", "s", at(1)), ("c", "NOTIFY", "s", at(2)), ("d", "FRAUD_CHECK", "s", at(3))],
        [("a", "FRAUD_CHECK", "r", at(9)), ("a", "RISK_SCORING", "s", at(9)), ("d", "FRAUD_CHECK", "r", at(12)), ("d", "FRAUD_CHECK", "s", at(12))],
        [("", "", "t", at(37))],
        [("c", "NOTIFY", "r", at(66)), ("", "", "t", at(80))],
        [("", "", "t", at(500))],
    ]
    for batch in batches:
        spark.createDataFrame(batch, EVENT).coalesce(1).write.mode("append").parquet(folder)
    events = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(folder)
    started = events.filter("kind = 's'").withColumnRenamed("at", "started_at")
    replied = events.filter("kind = 'r'").withColumnRenamed("at", "replied_at")
    sagas.step_timeouts(started, replied, root, ticks=events.filter("kind = 't'")).awaitTermination()
    found = jobs.read_batches(spark, root, "step_timeouts").select("saga_id", "step_name", "attempt", F.unix_timestamp("timed_out_at")).collect()
    zero = int(t0.replace(tzinfo=datetime.timezone.utc).timestamp())
    assert {(r[0], r[1], r[2], r[3] - zero) for r in found} == {
        ("a", "RISK_SCORING", 1, 39), ("b", "LEDGER_APPLY", 1, 31), ("c", "NOTIFY", 1, 32), ("c", "NOTIFY", 2, 62), ("d", "FRAUD_CHECK", 1, 42),
    }


def test_window_counts_by_loops():
    rng = np.random.default_rng(4)
    ms, seq = rng.integers(0, 40, 60) * 1000, rng.permutation(60)
    amount = rng.integers(1, 200, 60).astype(float)
    rule = FraudRule("r", 1, True, 1.0, 7000, 3, 100.0, 0.005, 2)
    asked = np.arange(20, 60)
    got = lookback.window_counts(ms, seq, amount, (amount * 100).astype(np.int64), asked, rule)
    for n, i in enumerate(asked):
        before = [j for j in range(60) if (ms[j], seq[j]) <= (ms[i], seq[i])]
        fast = [j for j in before if ms[j] >= ms[i] - 7000]
        slow = [j for j in before if ms[j] >= ms[i] - 18000 and amount[j] < 100]
        assert (got[0][n], got[1][n], got[2][n]) == (len(fast), len(slow), sum(int(amount[j] * 100) for j in slow))


TIGHT = FraudRule("rule-tight", 1, True, 10000.0, 6 * fraud.HOUR_MS, 2)


def _topic(spark, folder, records, parts):
    for low, high in zip(parts, parts[1:]):
        records.filter((F.col("offset") >= low) & (F.col("offset") < high)).coalesce(1).write.mode("append").parquet(folder)


def test_look_back_state_equals_batch(spark, data):
    """The second batch brings a new rule, whose wider windows find the payments of the first; late rows find theirs."""
    shuffled = S.raw_payments(spark, data).withColumn("offset", F.pmod(F.col("offset") * 617, F.lit(1009)))
    topic, rules, root = (shared_dir(spark, n) for n in ("topic", "rules", "keyed"))
    _topic(spark, topic, shuffled, [0, 400, 800, 2000])
    _topic(spark, rules, S.rule_log(spark), [0, 1, 2])
    log = spark.readStream.schema(S.rule_log(spark).schema).option("maxFilesPerTrigger", 1).parquet(rules)
    profiles = S.profiles(spark, data)
    for q in lookback.detect(file_stream(spark, topic, files_per_batch=1), log, root, lambda: profiles, shards=8):
        q.awaitTermination()
    records = spark.read.parquet(topic)
    want = None
    for rule, low, high in ((DEFAULT_RULE, 0, 400), (TIGHT, 400, 800), (TIGHT, 800, 2000)):
        seen = parsing.valid_payments(parsing.parse_payments(records.filter(F.col("offset") < high))).withColumn("seq", F.col("offset"))
        part = fraud.fraud_alerts(fraud.detect(seen, rule, profiles, keep=F.col("seq") >= low))
        want = part if want is None else want.unionByName(part)
    columns = ["user_id", "payment_id", "score", "reasons", "rule_id", "occurred_ms"]
    alerts = jobs.read_batches(spark, root, "alerts")
    assert _set(alerts.select(*columns)) == _set(want.select(*columns))
    assert alerts.filter(F.array_contains("reasons", "velocity")).count() > 0
    letters = jobs.read_batches(spark, root, "dead_letters")
    assert letters.count() == parsing.dead_letters(parsing.parse_payments(records)).count()


@pytest.mark.parametrize("keep_ms, seen", [(1, 1), (lookback.KEEP_MS, 2)])
def test_state_of_a_live_job_expires(spark, data, keep_ms, seen):
    """Two payments of an account in two batches a while apart."""
    raw = S.raw_payments(spark, data)
    good = parsing.valid_payments(parsing.parse_payments(raw)).select("offset").first()[0]
    one = raw.filter(F.col("offset") == good).withColumn("offset", F.lit(10).cast("long"))
    topic, rules, root = (shared_dir(spark, n) for n in ("topic", "rules", "live"))
    _topic(spark, rules, S.rule_log(spark), [0, 1])
    one.coalesce(1).write.parquet(topic)
    log = spark.readStream.schema(S.rule_log(spark).schema).parquet(rules)
    counted = lookback.counted(file_stream(spark, topic), log, shards=2, keep_ms=keep_ms)
    query = counted.writeStream.format("memory").queryName(f"live{seen}").option("checkpointLocation", root).trigger(processingTime="1 second").start()
    try:
        for n in (1, 2):
            waited = time.time()
            while spark.table(f"live{seen}").count() < n and time.time() - waited < 40:
                time.sleep(0.5)
            if n == 1:
                time.sleep(1)
                one.withColumn("offset", F.lit(11).cast("long")).coalesce(1).write.mode("append").parquet(topic)
    finally:
        query.stop()
    assert [r.window_count for r in spark.table(f"live{seen}").orderBy("seq").collect()] == [1, seen]


def test_requests_across_batches_and_restarts(spark):
    """The first of a key wins for good; equal ones get its reply, others fail; blank keys are always created."""
    schema = "idempotency_key string, body string, arrival long, reply string"
    deliveries = [
        [("k", "x", 5, "r5"), ("k", "x", 3, "r3"), ("k", "y", 4, "r4"), (None, "x", 1, "n1"), (" ", "x", 2, "n2"), ("n", None, 9, "z9")],
        [("k", "x", 1, "r1"), ("k", "y", 0, "r0"), ("m", "a", 7, "m7"), ("m", "b", 7, "m8"), (None, "x", 1, "n3"), ("n", None, 9, "z10")],
        [("m", "a", 9, "m9"), ("m", "b", 9, "m10"), ("k", "x", 99, "r99")],
    ]
    source, root = shared_dir(spark, "requests"), shared_dir(spark, "judged")
    for rows in deliveries:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        requests.judge(spark.readStream.schema(schema).parquet(source), root, shards=3).awaitTermination()
    found = jobs.read_batches(spark, root, "idempotency").collect()
    first = min("ab", key=lambda b: hashlib.sha256(b.encode()).hexdigest())
    reply = {"a": "m7", "b": "m8"}[first]

    def m(body, own):
        return (f"m{body}", *(("created", own) if own == reply else ("idempotent_hit", reply) if body == first else ("failed", None)))

    got = sorted(((r.idempotency_key or "") + (r.body or ""), r.outcome, r.reply or "") for r in found)
    want = [("kx", "created", "r3"), ("ky", "failed", ""), ("kx", "idempotent_hit", "r3"), ("x", "created", "n1"), (" x", "created", "n2"), ("n", "created", "z9")]
    want += [("kx", "idempotent_hit", "r3"), ("ky", "failed", ""), ("x", "created", "n3"), ("n", "idempotent_hit", "z9"), ("kx", "idempotent_hit", "r3")]
    want += [tuple(v or "" for v in m(*a)) for a in (("a", "m7"), ("b", "m8"), ("a", "m9"), ("b", "m10"))]
    assert got == sorted(want)
    with pytest.raises(ValueError):
        requests.judge(spark.readStream.schema(schema).parquet(source), root, keep_ms=5)


def _files(spark, name, batches, schema):
    folder = shared_dir(spark, name)
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_late_rows_are_counted(spark):
    """What was landed, what was late and what is still open are what was read."""
    t0 = datetime.datetime(2026, 1, 1)
    rng = random.Random(8)

    def rows(hour, many, late):
        spread = [hour * 60 + rng.randrange(60) for _ in range(many)] + [rng.randrange(max(1, hour * 60)) for _ in range(late)]
        return [(t0 + datetime.timedelta(minutes=m), rng.choice(["EUR", "USD"]), 1.0) for m in spread]

    batches = [rows(0, 40, 0), rows(3, 40, 10), rows(4, 40, 25), rows(9, 40, 30), rows(9, 5, 30), [(t0 + datetime.timedelta(days=9), "EUR", 1.0)], [(t0, "EUR", 1.0)] * 7]
    payments = _files(spark, "late", batches, "occurred_at timestamp, currency string, amount double")
    root, sent = shared_dir(spark, "hourly"), []
    counter = late.LateCounter(sent.append).start(spark)
    try:
        jobs.hourly_metrics(payments, root, late=counter).awaitTermination()
        waited = time.time()
        while counter.read < sum(map(len, batches)) and time.time() - waited < 30:
            time.sleep(0.2)
    finally:
        counter.stop(spark)
    landed = spark.read.parquet(f"{root}/hourly_metrics").agg(F.sum("payment_count")).first()[0]
    assert counter.read == sum(map(len, batches)) and all(b["exact"] for b in counter.batches)
    assert landed + counter.late + 1 == counter.read and counter.late > 7 and sent == counter.batches


def test_alarm_states_across_batches(spark):
    """One alarm fires over the end of a batch, one only gets pending; silence resolves them."""
    t0 = datetime.datetime(2026, 1, 1)

    def at(minute, many, name):
        return [(name, t0 + datetime.timedelta(minutes=minute, seconds=i % 60), True) for i in range(many)]

    first = at(0, 1, "high") + at(10, 400, "high") + at(11, 400, "high") + at(13, 1, "high") + at(13, 1, "slow") + at(10, 40, "slow")
    second = at(15, 500, "high") + at(16, 1, "high")
    clock = [(n, t0 + datetime.timedelta(minutes=m), False) for m in (60, 62) for n in ("high", "slow")]
    events = _files(spark, "alarms", [first, second, clock[:2], clock[2:]], "alarm string, at timestamp, counts boolean")
    root = shared_dir(spark, "watch")
    known = [alarms.Alarm("high", 1.0, 300, 300), alarms.Alarm("slow", 0.1, 300, 300)]
    alarms.watch(events, root, known).awaitTermination()
    rows = spark.read.parquet(f"{root}/alarms").selectExpr("alarm", "state", f"(unix_seconds(at) - unix_seconds(timestamp'{t0}')) div 60 AS m", "batch_id")
    found = sorted((r.alarm, r.m, r.state) for r in rows.collect())
    assert found == [("high", 11, "pending"), ("high", 16, "firing"), ("high", 21, "resolved"), ("slow", 11, "pending"), ("slow", 16, "resolved")]
    assert rows.filter("state = 'pending'").first().batch_id < rows.filter("state = 'firing'").first().batch_id
    high = spark.createDataFrame([r for r in first + second if r[0] == "high"], "alarm string, at timestamp, counts boolean")
    assert _set(alarms.spans(spark, root).drop("alarm")) == _set(monitoring.alarm_rate(high, "at", 1.0))
