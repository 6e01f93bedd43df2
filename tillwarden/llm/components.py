"""Connected components by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node of ``edges``.

    A round gives each node the smallest label among its neighbours and then the label of that label, so paths shrink
    by half and more. Only minima are shuffled; each round is written, which cuts the lineage.
    """
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = materialize(both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "edges")
    labels = materialize(both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("component")), "labels")
    while True:
        heard = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("component").alias("heard"))
        nearer = labels.join(heard, "node").select("node", F.col("component").alias("was"), F.least("component", "heard").alias("component"))
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("above"))
        jumped = nearer.join(up, "component", "left").select("node", "was", F.least("component", F.coalesce("above", "component")).alias("component"))
        new = materialize(jumped, "labels")
        if new.filter("component <> was").isEmpty():
            return new.select("node", "component")
        labels = new.select("node", "component")
