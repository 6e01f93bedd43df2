"""Hard negatives by exact search along spanning trees of anchors.

Anchors are dealt into blocks of similar ones, and each block gets the minimum spanning tree of its anchors. A task goes
down the tree for a block of rows: by the inequality of Cauchy and Schwarz a row's score at an anchor differs from that
at the parent by at most the length of the edge times the length of the row. So the parent's score, or what is known of
it, bounds the child's, and only rows whose bounds overlap the wanted window are scored anew. Scores are whole numbers
and exact. The first scan of the rows finds each anchor's positives, the second the negatives in their windows. Anchors
come in waves of ``WAVE_BYTES``, which bounds what is broadcast; all rows are scanned for each wave.

Defined results: rows with a null label or vector, or a null or non-finite component, take no part; a shorter vector is
padded with zeros; an empty table gives no rows; equal scores are ordered by id; rows equal in id, label and vector
count once, rows of one id with other vectors count each, and are not each other's positives; a score beyond 64 bits is
an error. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .texts import pick

#: Components are multiplied by this and rounded down.
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative scores between these shares of the positive's score, in hundredths.
LOW, HIGH = 50, 95
#: Bytes of anchors that are broadcast at once, anchors in a tree, and rows that are scored at once.
WAVE_BYTES = 8 << 20
TREE = 512
ROWS = 8_192
_EXACT = float(1 << 53)


@dataclass
class Wave:
    """Anchors in an order in which parents come before their children; a root's parent is -1."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    parents: np.ndarray
    edges: np.ndarray


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rounded components, padded with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    values = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    if len(values) and np.abs(values).max() >= 2.0**62:
        raise OverflowError("a component does not fit 64 bits")
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = values.astype(np.int64)
    return out


def _dots(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Exact inner products: by floating point where every sum fits 53 bits, else by 64-bit or Python numbers."""
    size = np.abs(vector.astype(np.float64)).max(initial=0.0) * np.abs(rows.astype(np.float64)).max(initial=0.0) * rows.shape[1]
    if size < 2.0**62:
        return rows @ vector
    return np.array([int(x) for x in rows.astype(object) @ vector.astype(object)], np.int64)


def _tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prim's minimum spanning tree: the order of the nodes, and of each in that order its parent and the edge's length."""
    many = len(vectors)
    wide = vectors.astype(np.float64)
    near, link, free = np.full(many, np.inf), np.full(many, -1), np.ones(many, bool)
    order, parents, edges, place = [], [], [], np.zeros(many, np.int64)
    now = 0
    for step in range(many):
        order.append(now)
        parents.append(place[link[now]] if link[now] >= 0 else -1)
        edges.append(near[now] if link[now] >= 0 else 0.0)
        place[now], free[now] = step, False
        length = np.sqrt(((wide - wide[now]) ** 2).sum(axis=1))
        closer = free & (length < near)
        near[closer], link[closer] = length[closer], now
        now = int(np.argmin(np.where(free, near, np.inf)))
    return np.array(order), np.array(parents), np.array(edges)


_ANCHOR = "part long, place int, id long, label int, x array<long>, parent int, edge double"
_ANCHOR_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.int32(), pa.float64()]


def _plant(width: int):
    """Trees over the sorted anchors of a partition; each is a part, numbered in the order of the range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first in range(0, batch.num_rows, TREE):
                block = batch.slice(first, TREE)
                vectors = _matrix(block.column(2), width)
                order, parents, edges = _tree(vectors)
                columns = [
                    np.full(len(order), part),
                    np.arange(len(order), dtype=np.int32),
                    block.column(0).to_numpy()[order],
                    block.column(1).to_numpy()[order],
                    list(vectors[order]),
                    parents.astype(np.int32),
                    edges,
                ]
                names = [c.split()[0] for c in _ANCHOR.split(", ")]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, _ANCHOR_TYPES)], names=names)
                part += 1

    return run


def _waves(anchors: DataFrame, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of parts that hold at most ``most`` anchors together, one part at least. The list has a row for each tree."""
    first = last = None
    held = 0
    for part, many in anchors.groupBy("part").count().orderBy("part").toLocalIterator():
        if first is not None and held + many > most:
            yield first, last
            first, held = None, 0
        first, last, held = part if first is None else first, part, held + many
    if first is not None:
        yield first, last


def _read_wave(anchors: DataFrame) -> Wave:
    table = anchors.orderBy("part", "place").toArrow()
    vectors = np.array(table["x"].combine_chunks().flatten()).reshape(table.num_rows, -1)
    ids, labels, parents, edges, place = (table[c].to_numpy() for c in ("id", "label", "parent", "edge", "place"))
    begun = np.arange(len(place)) - place
    return Wave(ids, labels, vectors, np.where(parents < 0, -1, parents + begun), edges)


class _Bounds:
    """What is known of a block's scores: for each anchor the last exact score of an ancestor and the way from there."""

    def __init__(self, wave: Wave, rows: np.ndarray):
        self.wave, self.rows = wave, rows
        self.length = np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9)
        wide = np.abs(rows.astype(np.float64)).max(initial=0.0) * np.abs(wave.vectors.astype(np.float64)).max(initial=0.0)
        self.float_safe = wide * max(rows.shape[1], 1) < _EXACT
        self.fast = rows.astype(np.float64) if self.float_safe else None
        self.left = np.bincount(wave.parents[wave.parents >= 0], minlength=len(wave.ids))
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def enter(self, anchor: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of all rows' scores at an anchor."""
        parent = int(self.wave.parents[anchor])
        if parent < 0:
            self.middle, self.way = np.zeros(len(self.rows)), np.full(len(self.rows), np.inf)
        else:
            self.middle, self.way = self.known[parent]
            self.left[parent] -= 1
            if self.left[parent] == 0:
                del self.known[parent]
            else:
                self.middle, self.way = self.middle.copy(), self.way.copy()
            self.way += self.wave.edges[anchor]
        slack = np.where(np.isinf(self.way), np.inf, self.way * self.length * (1 + 1e-9))
        slack = np.where(slack > 0, slack + np.abs(self.middle) * 1e-12 + 1e-6, 0.0)
        return self.middle - slack, self.middle + slack

    def rescore(self, anchor: int, which: np.ndarray) -> np.ndarray:
        """Exact scores of the rows with the given numbers, kept for the anchor's children."""
        vector = self.wave.vectors[anchor]
        if self.float_safe:
            whole = 2 * len(which) > len(self.rows)
            scores = (self.fast @ vector)[which] if whole else self.fast[which] @ vector
            scores = scores.astype(np.int64)
        else:
            scores = _dots(self.rows[which], vector)
        # Scores beyond 53 bits are not exact as floating point numbers; the slack above covers that.
        self.middle[which], self.way[which] = scores, 0.0 if self.float_safe else 1e-300
        return scores

    def leave(self, anchor: int) -> None:
        if self.left[anchor]:
            self.known[anchor] = (self.middle, self.way)


class _Best:
    """The best rows seen so far for each anchor (and window): highest score first, then the smallest id."""

    def __init__(self, places: int, many: int):
        self.many = many
        self.scores = [np.zeros(0, np.int64)] * places
        self.ids = [np.zeros(0, np.int64)] * places

    def least(self, place: int) -> float:
        """The score that a further row must reach."""
        return self.scores[place][-1] if len(self.scores[place]) == self.many else -np.inf

    def add(self, place: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(scores):
            return
        if len(scores) > 4 * self.many:
            few = np.partition(scores, len(scores) - self.many)[len(scores) - self.many]
            scores, ids = scores[scores >= few], ids[scores >= few]
        scores, ids = np.concatenate((self.scores[place], scores)), np.concatenate((self.ids[place], ids))
        order = np.lexsort((ids, -scores))
        scores, ids = scores[order], ids[order]
        new = np.ones(len(scores), bool)
        new[1:] = (scores[1:] != scores[:-1]) | (ids[1:] != ids[:-1])
        self.scores[place], self.ids[place] = scores[new][: self.many], ids[new][: self.many]

    def batch(self, **more) -> pa.RecordBatch:
        sizes = [len(s) for s in self.scores]
        place = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        found = {k: np.asarray(v)[place] for k, v in more.items()}
        joined = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (self.ids, self.scores)]
        return pa.record_batch(found | {"other": joined[0], "score": joined[1]})


def _row_blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            block = batch.slice(first, ROWS)
            yield block.column(0).to_numpy(), block.column(1).to_numpy(), _matrix(block.column(2), width)


def _find_positives(shared, width: int, many: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wave = shared.value
        best = _Best(len(wave.ids), many)
        for ids, labels, rows in _row_blocks(batches, width):
            bounds = _Bounds(wave, rows)
            for a in range(len(wave.ids)):
                _, upper = bounds.enter(a)
                which = np.flatnonzero((labels == wave.labels[a]) & (upper >= best.least(a)))
                which = which[ids[which] != wave.ids[a]]
                if len(which):
                    best.add(a, bounds.rescore(a, which), ids[which])
                bounds.leave(a)
        yield best.batch(place=np.arange(len(wave.ids), dtype=np.int32))

    return run


def _find_negatives(shared, windows, width: int, many: int, low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wave, (places, positives, scores) = shared.value, windows.value
        best = _Best(len(places), many)
        # By Python's numbers: a hundred times a score may pass 64 bits.
        least = np.array([-(-int(s) * low // 100) for s in scores], np.int64)
        most = np.array([int(s) * high // 100 for s in scores], np.int64)
        own = np.split(np.arange(len(places)), np.searchsorted(places, np.arange(1, len(wave.ids))))
        for ids, labels, rows in _row_blocks(batches, width):
            bounds = _Bounds(wave, rows)
            for a in range(len(wave.ids)):
                lower, upper = bounds.enter(a)
                open_ = [w for w in own[a].tolist() if least[w] <= most[w]]
                if open_:
                    floor = min(max(float(least[w]), best.least(w)) for w in open_)
                    ceiling = float(max(most[w] for w in open_))
                    which = np.flatnonzero((labels != wave.labels[a]) & (upper >= floor) & (lower <= ceiling))
                    if len(which):
                        found = bounds.rescore(a, which)
                        for w in open_:
                            fits = (found >= least[w]) & (found <= most[w])
                            best.add(w, found[fits], ids[which[fits]])
                bounds.leave(a)
        yield best.batch(place=places, anchor_id=wave.ids[places], positive=positives, positive_score=scores)

    return run


def _first(rows: DataFrame, keys: list[str], many: int) -> DataFrame:
    """The best rows of each key over all tasks; a task gives at most ``many`` for each."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "other")
    return rows.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= many)


def usable(vectors: DataFrame) -> DataFrame:
    """Rows that take part, of ``id``, ``label`` and ``vector``."""
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return pick(vectors, "id", "label", "vector").filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & fine)


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, wave_bytes: int = WAVE_BYTES
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the anchors among ``vectors``."""
    rows = usable(vectors).withColumn("vector", F.col("vector").cast("array<double>"))
    spark = vectors.sparkSession
    few = rows.filter(is_anchor).distinct()
    size = few.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    most = max(TREE, wave_bytes // (8 * max(width, 1)))
    result = None
    # The range also goes by id, so that copies of one vector are split.
    ordered = few.repartitionByRange(max(1, -(-size // most)), "label", "vector", "id").sortWithinPartitions("label", "vector", "id")
    anchors = materialize(ordered.mapInArrow(_plant(width), _ANCHOR), "anchors")
    for first, last in _waves(anchors, most):
        wave = _read_wave(anchors.filter(F.col("part").between(first, last)))
        shared = spark.sparkContext.broadcast(wave)
        near = rows.mapInArrow(_find_positives(shared, width, positives), "place int, other long, score long")
        table = _first(near, ["place"], positives).orderBy("place", "rank").toArrow()
        windows = spark.sparkContext.broadcast([table[c].to_numpy() for c in ("place", "other", "score")])
        schema = "place int, anchor_id long, positive long, positive_score long, other long, score long"
        found = rows.mapInArrow(_find_negatives(shared, windows, width, negatives, low, high), schema)
        part = materialize(_first(found, ["place", "anchor_id", "positive", "positive_score"], negatives), "negatives")
        result = part if result is None else result.unionByName(part)
    if result is None:
        schema = "place int, anchor_id long, positive long, positive_score long, other long, score long, rank int"
        result = spark.createDataFrame([], schema)
    return result.select(
        "anchor_id",
        F.col("positive").alias("positive_id"),
        "rank",
        F.col("other").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
