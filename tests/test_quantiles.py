import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwarden.functions import quantiles as Q
from tillwarden.session import materialize


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(2)
    rows = [(int(s), float(v)) for s, v in zip(rng.integers(0, 6, 40_000), rng.lognormal(1.0, 1.5, 40_000))]
    return rows, spark.createDataFrame(rows, "slot int, v double")


def test_written_partials_merge(spark, values):
    """States of slots, written and read, give over any windows what the values give."""
    rows, df = values
    parts = materialize(Q.partials(df, ["slot"], F.col("v")), "partials")
    windows = Q.merged(Q.sliding(parts, "slot", 3), ["slot"])
    whole = Q.merged(parts.select(F.lit(-1).alias("slot"), "counts", "sketch", "samples"), ["slot"])
    seen = windows.unionByName(whole)
    for share in (0.5, 0.95, 0.99):
        found = seen.select("slot", "samples", Q.bucket_quantile(F.col("counts"), share).alias("b"), Q.sketch_quantile(F.col("sketch"), share).alias("s"))
        for r in found.collect():
            own = np.sort([v for s, v in rows if r.slot < 0 or r.slot - 2 <= s <= r.slot])
            assert r.samples == len(own)
            # the sketch: a bound on the rank
            assert abs(np.searchsorted(own, r.s) / len(own) - share) < 0.02
            # buckets: within the bucket that holds the exact value
            exact, bounds = own[int(np.ceil(share * len(own))) - 1], (0.0, *Q.BOUNDS)
            i = int(np.searchsorted(Q.BOUNDS, exact))
            assert bounds[i] <= r.b <= Q.BOUNDS[min(i, len(Q.BOUNDS) - 1)]


def test_bucket_quantile_by_hand(spark):
    rows = [(1, [0, 0, 0]), (2, [0, 10, 10]), (3, [4, 4, 8]), (4, [10, 10, 10])]
    df = spark.createDataFrame(rows, "k int, counts array<long>")
    got = {r.k: r.q for r in df.select("k", Q.bucket_quantile(F.col("counts"), 0.8, (10.0, 20.0)).alias("q")).collect()}
    assert got == {1: None, 2: 18.0, 3: 20.0, 4: 8.0}
