"""Hard negatives against plain loops over all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwarden.llm import negatives


def brute(rows, every):
    fine = {(i, l, tuple(v)) for i, l, v in rows if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    width = max((len(v) for _, _, v in fine), default=0)
    fine = [(i, l, [math.floor(256 * float(np.float32(x))) for x in v] + [0] * (width - len(v))) for i, l, v in fine]
    out = set()
    for a, al, av in fine:
        if a % every:
            continue
        scored = {(-sum(x * y for x, y in zip(av, v)), i, l == al) for i, l, v in fine}
        for p, pid, _ in sorted(s for s in scored if s[2] and s[1] != a)[:5]:
            fits = sorted(s[:2] for s in scored if not s[2] and 50 * -p <= 100 * -s[0] <= 95 * -p)[:3]
            out |= {(a, pid, rank, n, -p, -s) for rank, (s, n) in enumerate(fits, 1)}
    return out


def mined(spark, rows, every=5, **more):
    df = spark.createDataFrame(rows, "id long, label int, vector array<float>")
    df = df.withColumns({"place": F.lit("x"), "score": F.lit("x"), "other": F.lit(1), "rank": F.lit(1)})
    return [tuple(r) for r in negatives.mine(df, F.col("id") % every == 0, **more).collect()]


def vectors(many, width, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(4, width))
    return [(i, int(rng.integers(0, 3)), (middles[rng.integers(0, 4)] + spread * rng.normal(size=width)).astype(np.float32).tolist()) for i in range(many)]


@pytest.mark.parametrize("spread", [0.02, 1.0])
@pytest.mark.parametrize("wave_bytes", [1, 8 << 20])
def test_all_pairs(spark, spread, wave_bytes, monkeypatch):
    monkeypatch.setattr(negatives, "TREE", 16)
    monkeypatch.setattr(negatives, "ROWS", 64)
    rows = vectors(300, 6, 1, spread)
    found = mined(spark, rows, wave_bytes=wave_bytes)
    assert len(found) == len(set(found)) and set(found) == brute(rows, 5) and found


def test_odd_rows(spark):
    rows = vectors(60, 4, 2)
    same = [(100 + i, i % 3, [1.0, 0.5, 0.25, 0.0]) for i in range(40)]
    odd = [(200, None, [1.0] * 4), (205, 1, None), (210, 1, [1.0, None, 0.0, 0.0]), (215, 1, [float("nan")] * 4), (220, 2, [float("inf"), 0.0, 0.0, 0.0])]
    short = [(225, 0, [0.9]), (230, 1, []), (235, 1, [0.0] * 4), (240, 2, [-0.001, -1.0, 0.0, 0.0])]
    twice = [rows[5], rows[5], (10, 2, [0.7, 0.7, 0.1, 0.1]), (11, 2, [0.7, 0.7, 0.1, 0.1]), (11, 1, [0.6, 0.7, 0.1, 0.1])]
    every = rows + same + odd + short + twice
    found = mined(spark, every)
    assert len(found) == len(set(found)) and set(found) == brute(every, 5)


def test_large_components(spark):
    """Sums beyond 53 bits stay exact."""
    rows = [(i, l, [x * 2.0**20 for x in v]) for i, l, v in vectors(80, 5, 3, 0.1)]
    assert set(mined(spark, rows)) == brute(rows, 5)
    with pytest.raises(Exception, match="64 bits"):
        mined(spark, [(0, 1, [1e30]), (1, 1, [1e30])])


def test_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(5, 1, [1.0])]) == []
    assert mined(spark, [(1, 1, [1.0]), (2, 2, [1.0])]) == []


def test_tree_is_minimal():
    points = np.array([[0, 0], [10, 0], [11, 0], [0, 1], [30, 30]])
    order, parents, edges = negatives._tree(points)
    assert sorted(order) == [0, 1, 2, 3, 4] and parents[0] == -1 and all(p < i for i, p in enumerate(parents))
    assert round(float(edges.sum()), 6) == round(1 + 10 + 1 + math.hypot(19, 30), 6)
