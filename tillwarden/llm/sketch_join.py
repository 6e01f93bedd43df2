"""N-gram Jaccard join by parity sketches: documents whose sets of five-word shingles have a Jaccard of 0.8 or more.

Sketches. Each shingle of a set falls by hash into one of ``PIECES`` pieces; a piece is the XOR of the hashes of its
shingles. A shingle that only one of two sets has changes one piece, so sketches differ in no more pieces than the
symmetric difference has shingles. A second sketch of ``BITS`` single bits has the same property by Hamming distance.
Two linked sets of sizes a <= b have b <= 1.25 a and differ in at most (a + b) / 9 shingles.

Size bands. Sets beyond ``WHOLE`` shingles are sketched from a share of all shingles, the same for every set of a band
(those with a small hash), so that a piece stays selective; a set near the end of a band is sketched for the next band
too. What linked sets may differ by there is a binomial quantile that is passed with a chance below 1e-9.

Pigeonhole join. If a set may differ in d pieces, then of any d + 1 of its pieces one agrees with a linked set. Taking
the rarest d + 1 (in one order for all sets) on both sides still finds all links, and keeps pieces made of common
passages out of the join: copies with many edits do not meet in the pieces of their template.

Groups. In each piece's group every set is compared with one central member; linked ones form components. Only
sets of different components are then compared pair by pair, inside the join under a bit sketch of ``WIDE_BITS``: the
narrow one, which every row carries, is full for sets of some hundred shingles, so that the texts of one template would
all be verified with each other. Every link is verified on whole shingle sets before it counts.

Rows. One per document: nulls, blank and empty texts have no shingles and no links; texts with fewer than five words
have one shingle. Equal sets are one node from the start, however many copies there are. Rows with equal doc_id
come out each with the component of their own text. A set that only rows without a doc_id have is linked with equal
sets alone, and its component has no name.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..session import materialize
from .components import components
from .texts import blocks, mix, pick, seeds, shingled

PIECES = 176
#: Bits of the sketch that all rows of a group carry, and of the one that only rows compared pair by pair get.
BITS, WIDE_BITS = 256, 1024
#: Largest set that is sketched whole, and shingles that a sketched set has at most (on average) beyond it.
WHOLE, SAMPLE = 640, 288
#: Rows up to which ids are broadcast instead of joined by shuffle; some 20 bytes each.
FEW_IDS = 500_000

_BANDS = seeds(64 * (PIECES + 1), 21).reshape(64, PIECES + 1)
_SUM, _BIT, _PIECE = seeds(3, 22)


def band_of(size: np.ndarray) -> np.ndarray:
    """0 for whole sets; band k keeps a share of 2 ** -(k + 1) of all shingles."""
    beyond = np.ceil(np.log2(np.maximum(size, 1) / SAMPLE)) - 1
    return np.where(size <= WHOLE, 0, np.maximum(beyond, 1)).astype(np.int64)


def most_in(band: int) -> int:
    return WHOLE if band == 0 else SAMPLE << (band + 1)


_APART: dict[tuple[int, int], int] = {}


def most_apart(size: int, band: int) -> int:
    """Pieces in which a set may differ from a linked one, both sketched for ``band``."""
    if (size, band) not in _APART:
        if len(_APART) > 100_000:
            _APART.clear()
        _APART[size, band] = _most_apart(size, band)
    return _APART[size, band]


def _most_apart(size: int, band: int) -> int:
    apart = (size + min(size * 5 // 4, most_in(band))) // 9
    if band == 0:
        return apart
    share = 0.5 ** (band + 1)
    tail, k = 0.0, apart
    while k >= 0:
        tail += exp(lgamma(apart + 1) - lgamma(k + 1) - lgamma(apart - k + 1) + k * log(share) + (apart - k) * log(1 - share))
        if tail > 1e-9:
            return k
        k -= 1
    return 0


def distinct_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, and the first of each text."""
    hashes, firsts = shingled(column)
    text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    hashes, text = hashes[new], text[new]
    return hashes, np.searchsorted(text, np.arange(len(firsts)))


def _group_sums(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return sums[firsts[1:]] - sums[firsts[:-1]]


def set_names(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """A 64-bit name for each set; equal sets have equal names."""
    return mix(_group_sums(mix(hashes ^ _SUM), firsts) + np.diff(firsts).astype(np.uint64)).view(np.int64)


def bit_sketches(hashes: np.ndarray, firsts: np.ndarray, width: int = BITS) -> np.ndarray:
    """Rows of width / 64 whole numbers, worked out for some sets at a time."""
    sets, most = len(firsts) - 1, (1 << 20) // width
    if sets > most:
        cuts = [firsts[i : i + most + 1] for i in range(0, sets, most)]
        return np.concatenate([bit_sketches(hashes[c[0] : c[-1]], c - c[0], width) for c in cuts])
    text = np.repeat(np.arange(sets), np.diff(firsts))
    bit = (mix(hashes ^ _BIT) & np.uint64(width - 1)).astype(np.int64)
    odd = (np.bincount(text * width + bit, minlength=sets * width) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).reshape(sets, width // 64)


def pieces(hashes: np.ndarray, text: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the pieces that are not empty, and the text of each; ``band`` is that of each text."""
    own = band[text]
    kept = (own == 0) | (hashes < (np.uint64(1) << np.minimum(63 - own, 63).astype(np.uint64)))
    hashes, text = hashes[kept], text[kept]
    spread = mix(hashes ^ _PIECE)
    piece = (spread % np.uint64(PIECES)).astype(np.int64)
    order = np.argsort(text * PIECES + piece, kind="stable")
    slot = (text * PIECES + piece)[order]
    starts = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1]))) if len(slot) else np.zeros(0, np.int64)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    parity = np.bitwise_xor.reduceat(spread[order], starts)
    at = slot[starts] // PIECES
    return mix(parity ^ _BANDS[band[at], slot[starts] % PIECES]), at


def _lists(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(values))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets' names, and the sketches of each set that is new in this partition."""
    seen: set[int] = set()
    for whole in batches:
        for batch in blocks(whole, "text"):
            hashes, firsts = distinct_sets(batch.column("text"))
            size = np.diff(firsts)
            name = set_names(hashes, firsts)
            fresh = np.zeros(len(size), bool)
            for i, (s, k) in enumerate(zip(name.tolist(), size.tolist(), strict=True)):
                if k and s not in seen:
                    seen.add(s)
                    fresh[i] = True
            text = np.repeat(np.arange(len(size)), size)
            out = [batch.column("doc_id"), pa.array(size.astype(np.int64)), pa.array(name)]
            bits = bit_sketches(hashes, firsts).reshape(-1)
            width = BITS // 64
            low, high = band_of(size), band_of(size * 5 // 4)
            for band, wanted in ((low, fresh), (high, fresh & (high > low))):
                some = wanted[text]
                keys, at = pieces(hashes[some], text[some], band)
                count = np.bincount(at, minlength=len(size))
                bound = np.array([most_apart(int(n), int(b)) if w else 0 for n, b, w in zip(size, band, wanted, strict=True)], dtype=np.int64)
                # too few pieces for the pigeonhole: such sets meet in one more key of their band
                short = wanted & (count <= bound)
                keys = np.concatenate((keys, _BANDS[band[short], PIECES]))
                at = np.concatenate((at, np.flatnonzero(short)))
                order = np.argsort(at, kind="stable")
                keys, at = keys[order], at[order]
                bound[short] = 10 * PIECES
                out += [pa.array(bound.astype(np.int32)), _lists(keys.view(np.int64), np.searchsorted(at, np.arange(len(size) + 1)))]
            out.append(_lists(bits, np.arange(len(size) + 1) * width))
            some = np.where(fresh, WIDE_BITS // 64, 0)
            wide = bit_sketches(hashes, firsts, WIDE_BITS)[fresh].reshape(-1)
            out.append(_lists(wide, np.concatenate(([0], np.cumsum(some)))))
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "n_shingles", "node", "bound0", "keys0", "bound1", "keys1", "bits", "wide"])


def _near(a: str, b: str, width: int = BITS) -> Column:
    """Sizes and bit sketches of two rows allow a link."""
    size_a, size_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    apart = sum((F.bit_count(F.col(f"{a}.bits")[i].bitwiseXOR(F.col(f"{b}.bits")[i])) for i in range(width // 64)), F.lit(0))
    return (size_a * 100 >= size_b * 80) & (size_b * 100 >= size_a * 80) & (apart * 9 <= size_a + size_b)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted sets as binaries of five bytes a shingle, in ascending order."""
    for whole in batches:
        for batch in blocks(whole, "text"):
            hashes, firsts = distinct_sets(batch.column("text"))
            right = set_names(hashes, firsts) == batch.column("node").to_numpy()
            low = np.ascontiguousarray(hashes >> np.uint64(24)).view(np.uint8).reshape(-1, 8)[:, :5]
            sets = [low[a:b].tobytes() for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
            found = pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], ["node", "shingles"])
            yield found.filter(pa.array(right))


def _unpack(raw: bytes | pa.Buffer) -> np.ndarray:
    wide = np.zeros((len(raw) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return wide.reshape(-1).view(np.uint64)


def linked(left: bytes | pa.Buffer, right: bytes | pa.Buffer) -> bool:
    a, b = _unpack(left), _unpack(right)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 80 * (len(a) + len(b) - both)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        # Each set is read in place: a batch may hold many long ones.
        kept = [linked(x.as_buffer(), y.as_buffer()) for x, y in zip(batch.column("left"), batch.column("right"), strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))


def verified(pairs: DataFrame, docs: DataFrame, names: DataFrame) -> DataFrame:
    """The pairs (a, b) of set names whose shingle sets are linked. ``names`` has one doc_id for each set."""
    needed = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    needed = materialize(needed.join(names, "node").select("node", F.col("first").alias("doc_id")), "wanted")
    if needed.count() <= FEW_IDS:
        needed = F.broadcast(needed)
    texts = pick(docs, "doc_id", "text").join(needed, "doc_id").select("node", "text")
    sets = materialize(texts.mapInArrow(_packed, "node long, shingles binary").dropDuplicates(["node"]), "sets")
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("left")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("right")), "b")
    return materialize(both.select("a", "b", "left", "right").mapInArrow(_verify, "a long, b long"), "links")


def candidates(sketches: DataFrame) -> DataFrame:
    """Rows (key, node, n, bits, weight) of the rarest pieces of each set that can have a partner at all."""
    rows = None
    for k in (0, 1):
        part = sketches.select("node", F.col("n_shingles").alias("n"), F.lit(k).alias("band"), F.col(f"bound{k}").alias("bound"), F.size(f"keys{k}").alias("all"), F.explode(f"keys{k}").alias("key"))
        rows = part if rows is None else rows.unionByName(part)
    shared = rows.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("met"))
    # written, so that both sides of the join are plain shuffles and a hot piece is split among tasks
    shared = materialize(shared.filter("low <> high").select("key", "met"), "shared-pieces")
    hits = rows.join(shared, "key").repartition("node", "band").dropDuplicates(["node", "band", "key"])
    own = W.partitionBy("node", "band")
    ranked = hits.withColumns(
        {"rank": F.row_number().over(own.orderBy("met", "key")), "here": F.count("*").over(own), "weight": F.sum("met").over(own)}
    )
    return ranked.filter("rank <= bound + 1 - (all - here)").select("key", "node", "n", "weight")


def _with_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the name of their own shingle set as the last column."""
    for whole in batches:
        for batch in blocks(whole, "text"):
            names = pa.array(set_names(*distinct_sets(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([*batch.columns, names], [*batch.schema.names, "_set"])


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest doc_id; rows without a doc_id stay.

    Repeated rows of a kept doc_id are one document and stay together. Rows of one doc_id with different texts are
    judged each by its own text, so that the last copy of a text is never dropped for another text of its id.
    """
    judged = materialize(join(docs).filter("doc_id IS NOT NULL").select("doc_id", "node", "component_id"), "judged")
    gone = judged.filter("doc_id <> component_id").select("doc_id", "node").distinct()
    spans = judged.groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("node").alias("named"), F.count("*").alias("all"))
    # NULL stands for a text without shingles
    several = materialize(spans.filter("low <> high OR (named > 0 AND named < all)").select("doc_id"), "several-texts")
    single = materialize(gone.join(several, "doc_id", "left_anti").select("doc_id").distinct(), "copies")
    dropped = F.broadcast(single) if single.count() <= FEW_IDS else single
    columns = [F.col(f"`{c}`") for c in docs.columns]
    kept = docs.join(dropped, "doc_id", "left_anti")
    if several.isEmpty():
        return kept.select(*columns)
    usual = kept.join(several, "doc_id", "left_anti").select(*columns)
    mixed = docs.join(several, "doc_id", "left_semi").select(*columns)
    named = mixed.mapInArrow(_with_names, T.StructType([*mixed.schema.fields, T.StructField("_set", T.LongType())]))
    names = gone.select(F.col("doc_id").alias("_id"), F.col("node").alias("_node"))
    own = named.join(names, (named["doc_id"] == names["_id"]) & (named["_set"] == names["_node"]), "left_anti")
    return usual.unionByName(own.drop("_set"))


def join(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of each row, with ``node`` (the name of its shingle set)."""
    sketches = materialize(pick(docs, "doc_id", "text").mapInArrow(_sketch, _SKETCH), "sketches")
    names = sketches.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("first"))
    picked = materialize(candidates(sketches), "pieces")
    # sketches of the sets that are left
    bits = sketches.filter("size(keys0) > 0").select("node", "bits").join(picked.select("node").distinct(), "node").dropDuplicates(["node"])
    held = materialize(picked.join(bits, "node"), "held")
    central = held.groupBy("key").agg(F.max_by(F.struct("node", "n", "bits"), F.struct("weight", "node")).alias("c"), F.count("*").alias("met"))
    central = central.filter("met > 1").select("key", F.col("c.node").alias("node"), F.col("c.n").alias("n"), F.col("c.bits").alias("bits"))
    central = materialize(central, "central")
    star = held.alias("x").join(central.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.node") != F.col("y.node")) & _near("x", "y"))
    star = materialize(star.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct(), "pairs")
    links = verified(star, docs, names)
    groups = components(links)
    # pairs of sets that have not met through a central one
    placed = held.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("key")
    split = materialize(split, "split-groups")
    mixed = materialize(placed.drop("bits", "weight").join(split, "key"), "mixed")
    wide = sketches.filter("size(wide) > 0").select("node", F.col("wide").alias("bits")).join(mixed.select("node").distinct(), "node").dropDuplicates(["node"])
    mixed = materialize(mixed.join(wide, "node"), "mixed")
    x, y = mixed.alias("x"), mixed.alias("y")
    rest = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.component") != F.col("y.component")) & _near("x", "y", WIDE_BITS))
    rest = materialize(rest.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct().join(star, ["a", "b"], "left_anti"), "pairs")
    if not rest.isEmpty():
        links = links.unionByName(verified(rest, docs, names))
        groups = components(links)
    least = names.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = least.groupBy("component").agg(F.min("first").alias("component_id"))
    of_node = materialize(least.join(lowest, "component").select("node", "component_id"), "nodes")
    # a text without shingles is linked with nothing, a hot set is split by adaptive execution
    full = sketches.filter("n_shingles > 0").select("doc_id", "n_shingles", "node").join(of_node, "node", "left")
    none = sketches.filter("n_shingles = 0").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("node"), F.col("doc_id").alias("component_id"))
    return full.select("doc_id", "n_shingles", "node", "component_id").unionByName(none).select("doc_id", "n_shingles", "component_id", "node")


_SKETCH = "doc_id long, n_shingles long, node long, bound0 int, keys0 array<long>, bound1 int, keys1 array<long>, bits array<long>, wide array<long>"
