"""Ordered operators against brute force, with and without cells for hot keys."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillwarden.functions.joins import salted_join
from tillwarden.functions.ordered import LookBack, carry_forward, exact_percentile, look_back, running_totals

WHOLE = 10**9


def _events(seed, rows=400, keys=("a", "b", None)):
    """In-order events; key ``a`` is hot and many share a millisecond."""
    rng = random.Random(seed)
    now, out = 1_700_000_000_000, []
    for seq in range(rows):
        now += rng.choice([0, 0, 1, 7, 40])
        key = rng.choices(keys, weights=[8, 1, 1])[0]
        out.append((key, now, seq, Decimal(rng.randrange(0, 20_000)) / 100))
    return out


@pytest.mark.parametrize("limit", [WHOLE, 20])
@pytest.mark.parametrize("seed", [1, 2])
def test_look_back_equals_fold(spark, seed, limit):
    rows = _events(seed)
    df = spark.createDataFrame(rows, "k string, ms long, seq long, amount decimal(19,4)")
    small = F.when(F.col("amount") < 99, F.col("amount")).otherwise(F.lit(0).cast("decimal(19,4)"))
    sums = [LookBack("n", 50, F.lit(1).cast("long")), LookBack("s", 200, small)]
    got = {r.seq: (r.n, r.s) for r in look_back(df, ["k"], "ms", "seq", sums, cell_ms=30, limit=limit).collect()}
    assert len(got) == len(rows)
    for i, (key, ms, seq, _) in enumerate(rows):
        seen = [r for r in rows[: i + 1] if r[0] == key]
        n = sum(1 for r in seen if r[1] >= ms - 50)
        s = sum((r[3] for r in seen if r[1] >= ms - 200 and r[3] < 99), Decimal(0))
        assert got[seq] == (n, s)


@pytest.mark.parametrize("limit", [WHOLE, 20])
def test_running_totals_equals_fold(spark, limit):
    rows = _events(3)
    df = spark.createDataFrame(rows, "k string, ms long, seq long, amount decimal(19,4)")
    totals = running_totals(df, ["k"], ["seq"], "seq", ["amount"], width=17, limit=limit)
    got = {r.seq: r.amount for r in totals.collect()}
    state = {}
    for key, _, seq, amount in rows:
        state[key] = state.get(key, Decimal(0)) + amount
        assert got[seq] == state[key]


@pytest.mark.parametrize("limit", [WHOLE, 20])
def test_carry_forward_equals_fold(spark, limit):
    rows = [(k, ms, seq, None if seq % 3 else seq) for k, ms, seq, _ in _events(4)]
    df = spark.createDataFrame(rows, "k string, ms long, seq long, v long")
    got = {r.seq: r.v for r in carry_forward(df, ["k"], ["ms", "seq"], "ms", "v", width=25, limit=limit).collect()}
    state = {}
    for key, _, seq, value in rows:
        state[key] = value if value is not None else state.get(key)
        assert got[seq] == state[key]


@pytest.mark.parametrize("limit", [WHOLE, 5])
def test_exact_percentile(spark, limit):
    rng = random.Random(5)
    rows = [("x" if rng.random() < 0.8 else "y", rng.randrange(0, 500)) for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, v long")
    got = {r.k: (r.p, r.samples) for r in exact_percentile(df, ["k"], "v", 0.95, "p", width=50, limit=limit).collect()}
    for key in ("x", "y"):
        values = sorted(v for k, v in rows if k == key)
        at = 0.95 * (len(values) - 1)
        low = int(at)
        want = values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (at - low)
        assert got[key][0] == pytest.approx(want)
        assert got[key][1] == len(values)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_join(spark, how):
    left = spark.range(500).select(F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("7", 3)], "k string, v int")
    plain = sorted(map(tuple, left.join(right, "k", how).select("id", "k", "v").fillna(-1).collect()))
    salted = salted_join(left, right, ["k"], how, limit=10, salts=4)
    assert sorted(map(tuple, salted.select("id", "k", "v").fillna(-1).collect())) == plain


def test_look_back_shuffles_rows_once(spark):
    """Only the key count, the cell totals and their order add small shuffles of their own."""
    df = spark.createDataFrame(_events(6), "k string, ms long, seq long, amount decimal(19,4)")
    out = look_back(df, ["k"], "ms", "seq", [LookBack("n", 50, F.lit(1).cast("long"))])
    plan = out._jdf.queryExecution().executedPlan().toString()
    widest = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "_cell" in line]
    assert len(widest) == 2
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
