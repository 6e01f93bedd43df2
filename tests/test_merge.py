"""Merging of landed batches behind a manifest."""

import datetime
import os

from tillwarden.operators import landing
from tillwarden.plans import merge
from tillwarden.session import shared_dir

TABLE = "payment_events"
SCHEMA = "account_id string, occurred_at timestamp, event_id string, amount double, offset long"


def _land(spark, root, batch, rows):
    made = [(a, datetime.datetime(2024, month, day), e, x, o) for a, month, day, e, x, o in rows]
    df = spark.createDataFrame(made, SCHEMA).selectExpr("*", "date_format(occurred_at, 'yyyyMM') AS month")
    df.write.partitionBy("month").parquet(f"{root}/{TABLE}/batch_id={batch}")


def _rows(df):
    return sorted((r.account_id, r.event_id, r.amount, r.offset) for r in df.collect())


def _files(path):
    return {f: os.stat(f"{path}/{f}").st_mtime_ns for f in os.listdir(path) if f.endswith(".parquet")}


def test_merge(spark):
    root = shared_dir(spark, "merged")
    first = [("a", 1, 5, "e1", 1.0, 1), ("a", 2, 5, "e2", 2.0, 2), ("b", 3, 5, "e3", 3.0, 3), ("a", 1, 5, "e1", 1.5, 4)]
    second = [("a", 2, 5, "e2", 2.5, 5), ("c", 2, 6, "e4", 4.0, 6)]
    _land(spark, root, 0, first)
    before = merge.read_landed(spark, root, TABLE)
    want = [("a", "e1", 1.5, 4), ("a", "e2", 2.0, 2), ("b", "e3", 3.0, 3)]
    assert _rows(before) == want
    one = merge.merge(spark, root, TABLE)
    assert (one.version, one.upto, sorted(one.months)) == (0, 1, ["202401", "202402", "202403"])
    assert _rows(merge.read_landed(spark, root, TABLE)) == want

    _land(spark, root, 1, second)
    old_reader = merge.read_landed(spark, root, TABLE)  # reads batch 1 and the months of the first manifest
    untouched = _files(one.months["202401"])
    two = merge.merge(spark, root, TABLE)
    want = [("a", "e1", 1.5, 4), ("a", "e2", 2.5, 5), ("b", "e3", 3.0, 3), ("c", "e4", 4.0, 6)]
    assert _rows(old_reader) == _rows(merge.read_landed(spark, root, TABLE)) == want
    assert two.months["202401"] == one.months["202401"] and two.months["202402"] != one.months["202402"]
    assert _files(two.months["202401"]) == untouched
    assert _rows(merge.read_landed(spark, root, TABLE, {"202402"})) == [want[1], want[3]]
    # A settled month is not sorted again.
    plan = merge.read_landed(spark, root, TABLE)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan

    # A manifest that was not written to its end is no manifest; an unfinished batch is no batch.
    os.makedirs(f"{root}/{TABLE}_manifest/version=9")
    os.makedirs(f"{root}/{TABLE}/batch_id=2/month=202402")
    assert merge.read_manifest(spark, root, TABLE) == two and _rows(merge.read_landed(spark, root, TABLE)) == want


def test_retention_and_vacuum(spark):
    root = shared_dir(spark, "merged")
    assert merge.read_landed(spark, root, TABLE) is None
    _land(spark, root, 0, [("a", 1, 5, "e1", 1.0, 1), ("a", 2, 5, "e2", 2.0, 2)])
    one = merge.merge(spark, root, TABLE)
    _land(spark, root, 1, [("a", 2, 5, "e2", 2.5, 3), ("a", 1, 9, "e0", 9.0, 4)])
    two = merge.merge(spark, root, TABLE, keep_from="202402")
    assert sorted(two.months) == ["202402"] and _rows(merge.read_landed(spark, root, TABLE)) == [("a", "e2", 2.5, 3)]
    # Readers of the manifest before still have its folders, until it is not kept any more.
    assert len(_rows(merge.read_landed(spark, root, TABLE, manifest=one))) == 3
    assert merge.vacuum(spark, root, TABLE, keep=2) == [f"{root}/{TABLE}/batch_id=0"]
    gone = merge.vacuum(spark, root, TABLE, keep=1)
    assert one.months["202401"] in gone and not os.path.exists(one.months["202401"]) and os.path.exists(two.months["202402"])
    assert _rows(merge.read_landed(spark, root, TABLE)) == [("a", "e2", 2.5, 3)]


def test_merges_of_a_stream_equal_one_dedup(spark):
    """Batches with copies in later ones, merged every other time."""
    root, every = shared_dir(spark, "merged"), []
    for batch in range(5):
        rows = [(f"a{i % 4}", 1 + (i * 7) % 6, 1 + i % 9, f"e{i % 30}", float(batch * 100 + i), batch * 100 + i) for i in range(batch * 5, batch * 5 + 40)]
        every += rows
        _land(spark, root, batch, rows)
        if batch % 2:
            merge.merge(spark, root, TABLE)
    whole = spark.createDataFrame([(a, datetime.datetime(2024, m, d), e, x, o) for a, m, d, e, x, o in every], SCHEMA)
    assert _rows(merge.read_landed(spark, root, TABLE)) == _rows(landing.dedup_replacing(whole, landing.SORT_KEYS[TABLE]))
