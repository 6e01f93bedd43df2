"""Benchmark decontamination: short test items inside long documents, by MinHash containment search over size partitions.

A test item's signature is the ``SIGNATURE`` smallest hashes of its five-word shingles. Items are partitioned by
size (factors of two); a partition's cut-off is the largest hash in its signatures. A document holds an item only if
its shingles hold the item's signature, so a document's side is its shingle hashes up to the highest cut-off: its own
length plays no part, however long it is. Documents that share ``NEEDED`` of a signature (of a full one; one hash of a
shorter one) are candidates: at a containment of 0.8 fewer than one pair in ten thousand has less. The exact share of
an item's shingles found in the document decides.

All of it is DataFrame functions: a document's shingles are made and looked up in one pass without a shuffle. The
signatures are broadcast after a count; a benchmark beyond ``FEW`` rows is joined by shuffle, split where a
shingle is hot. Only matches are shuffled.

Words are what stands between blanks, in lower case; fewer than five words are one shingle. Null and blank texts
have none: such items are in no document and such documents hold no item. Rows of one doc_id count as one document,
rows of one item_id as one item; rows without an id are not judged. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import materialize
from .texts import SHINGLE, pick

SIGNATURE, NEEDED = 8, 2
CONTAINED = 0.8
#: Rows of a benchmark's shingles up to which they are broadcast; some 40 bytes each.
FEW = 1_000_000

BLANKS = "[ \\t-\\r]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), BLANKS), "")


def shingle_rows(table: DataFrame, key: str, *more: str) -> DataFrame:
    """``key`` and the hash ``h`` of every shingle of its text, repeated ones too."""
    words = pick(table, key, "text", *more).filter(F.col(key).isNotNull() & F.col("text").isNotNull()).select(key, *more, words_of(F.col("text")).alias("w"))
    last = F.greatest(F.size("w") - SHINGLE, F.lit(0))
    places = words.filter(F.size("w") > 0).select(key, *more, "w", F.explode(F.sequence(F.lit(0), last)).alias("i"))
    return places.select(key, *more, F.xxhash64(*[F.get("w", F.col("i") + k) for k in range(SHINGLE)]).alias("h"))


def _small(table: DataFrame) -> DataFrame:
    """A written table, with a hint to broadcast it if it is small."""
    return F.broadcast(table) if table.count() <= FEW else table


def signatures(items: DataFrame) -> DataFrame:
    """``item_id``, ``h``, the item's ``size`` (its shingles), ``part`` (its size partition) and ``signed``: h is in the signature."""
    rows = shingle_rows(items, "item_id").distinct()
    own = W.partitionBy("item_id")
    sized = rows.withColumns({"size": F.count("*").over(own), "rank": F.row_number().over(own.orderBy("h"))})
    return sized.select("item_id", "h", "size", F.floor(F.log2("size")).cast("int").alias("part"), (F.col("rank") <= SIGNATURE).alias("signed"))


def contained(docs: DataFrame, items: DataFrame, least: float = CONTAINED) -> DataFrame:
    """``doc_id``, ``item_id``, ``containment`` of all pairs with ``least`` or more of the item's shingles in the document."""
    shingles = materialize(signatures(items), "items")
    signed = materialize(shingles.filter("signed").select("item_id", "h", "size", "part"), "signatures")
    cuts = {r["part"]: r["cut"] for r in signed.groupBy("part").agg(F.max("h").alias("cut")).collect()}  # a number for each doubling of size
    found = shingle_rows(docs, "doc_id").filter(F.col("h") <= max(cuts.values(), default=0))
    met = found.join(_small(signed), "h").groupBy("doc_id", "item_id").agg(F.count_distinct("h").alias("n"), F.first("size").alias("size"))
    pairs = materialize(met.filter((F.col("n") >= NEEDED) | (F.col("size") < SIGNATURE)).select("doc_id", "item_id"), "leaks")
    ids = _small(materialize(pairs.select("doc_id").distinct(), "leak-docs"))
    again = shingle_rows(docs.join(ids, "doc_id", "left_semi"), "doc_id")
    both = again.join(_small(shingles.select("item_id", "h", "size")), "h").distinct()
    share = both.groupBy("doc_id", "item_id").agg((F.count("*") / F.first("size")).alias("containment"))
    return share.filter(F.col("containment") >= least).join(pairs, ["doc_id", "item_id"], "left_semi").select("doc_id", "item_id", "containment")


def clean(docs: DataFrame, items: DataFrame, least: float = CONTAINED) -> DataFrame:
    """``docs`` without those that hold an item; rows without a doc_id stay."""
    held = _small(materialize(contained(docs, items, least).select("doc_id").distinct(), "held"))
    return docs.join(held, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
