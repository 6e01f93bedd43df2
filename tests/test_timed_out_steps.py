"""Steps without a reply in time, over batches and restarts."""

import datetime

from pyspark.sql import functions as F

from tillwarden.session import shared_dir
from tillwarden.streaming import jobs

T0 = datetime.datetime(2026, 1, 1)
EVENT = "saga_id string, step_name string, kind string, at timestamp"


def _at(seconds):
    return T0 + datetime.timedelta(seconds=seconds)


def test_open_steps_are_kept_between_batches(spark):
    """A batch's steps were all held in the memory of the executors until it was over; now the open ones go on, no others."""
    batches = [
        [(f"x{i}", "NOTIFY", k, _at(i % 50)) for i in range(2000) for k in "sr"] + [("a", "N", "s", _at(10)), ("a", "N", "r", _at(40)), ("b", "N", "s", _at(10)), ("b", "N", "r", _at(41)), ("e", "N", "s", _at(48)), ("g", "N", "s", _at(45)), (None, "N", "s", _at(1)), ("d", None, "s", _at(2)), ("d", None, "r", _at(3))],
        [("e", "N", "r", _at(60)), ("f", "N", "s", _at(60)), ("g", "N", "r", _at(76)), ("late", "N", "s", _at(20)), ("early", "N", "r", _at(70))],
        [("early", "N", "s", _at(69)), ("y", "N", "s", _at(500)), ("y", "N", "r", _at(500))],
    ]
    source, root = shared_dir(spark, "steps"), shared_dir(spark, "timed")
    kept = []
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(source)
        events = spark.readStream.schema(EVENT).parquet(source)
        started = events.filter("kind = 's'").withColumnRenamed("at", "started_at")
        replied = events.filter("kind = 'r'").withColumnRenamed("at", "replied_at")
        jobs.timed_out_steps(started, replied, root).awaitTermination()
        kept.append(spark.read.parquet(f"{root}/_state/timed_out_steps/{n % 2}/kept").count())
    found = jobs.read_batches(spark, root, "timed_out_steps")
    # "late" lay behind the time of its batch; the reply to "b" came a second too late, that to "a" just in time.
    assert sorted((r.saga_id or "", r.step_name or "") for r in found.collect()) == [("", "N"), ("b", "N"), ("d", ""), ("f", "N"), ("g", "N")]
    assert found.select("status", "error_message", "is_compensation").distinct().count() == 1 and max(kept) < 300


def test_a_step_is_out_when_time_has_passed_its_limit(spark):
    """Of steps at the very limit the one whose reply could still come is not told."""
    rows = [("p", "N", "s", _at(64)), ("q", "N", "s", _at(65)), ("z", "N", "s", _at(100)), ("z", "N", "r", _at(100))]
    source, root = shared_dir(spark, "steps"), shared_dir(spark, "timed")
    spark.createDataFrame(rows, EVENT).coalesce(1).write.parquet(source)
    events = spark.readStream.schema(EVENT).parquet(source)
    started, replied = (events.filter(F.col("kind") == k).withColumnRenamed("at", name) for k, name in (("s", "started_at"), ("r", "replied_at")))
    jobs.timed_out_steps(started, replied, root).awaitTermination()
    assert [r.saga_id for r in jobs.read_batches(spark, root, "timed_out_steps").collect()] == ["p"]
