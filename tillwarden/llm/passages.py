"""Substring dedup by compact windows: passages of 50 words and more that occur in other documents too.

Windows. A text is a sequence of five-word shingles. For each of ``HASHES`` hash functions the runs of at least
``RUN`` shingles that have the same shingle as their minimum form one compact window (left, centre, right): every run
between left and right that holds the centre. Windows are the nodes of the Cartesian tree over the hashes whose
span is long enough; a node's parent is such a node too, so the tree is built over the minima of sliding windows
alone, some 2 of every ``RUN`` positions. A window ends beside the nearest lesser minimum on each side; these are found for
all texts of a block at once.

Join. Windows with the same minimum come from runs that agree in a min-hash. In each group every window meets the
smallest document alone, so a group of m documents makes m - 1 rows, whatever m is. A window meets every place that the
other document has of the same minimum. Rows of a pair of documents are grouped by diagonal (the distance of the two
places) and then by place, and a group counts when ``ENOUGH`` functions agree in it.

Finer keys. Windows that do not lie in a passage confirmed so far, such as those at a line that many documents have and
nothing else, form groups anew: the runs around them are cut in parts, and the minima of all parts together
are the key (``FINER``). Again each group meets its smallest document alone. Of every run one place is a multiple of
``RUN``; only where windows of enough functions hold such a place and are shared, runs get a finer key. The last key is the
whole run, so an exact copy of a run always meets one. Every step is in proportion to the windows it starts from; no group
is ever paired with itself.

Verification. The shingles of both stretches are compared in place: a passage is a longest stretch of at least
``RUN`` shingles in which four of five agree, at ends that agree; a stretch may be longer than the windows that
found it.

Result: one row per passage of a document that an earlier one has too, with its place there, counted in words; of
passages within a longer one of the same document only the longer is told, and of earlier documents that a passage was
met in the smallest. Nulls,
empty texts and texts of fewer than 50 words have none, and neither have rows without a doc_id, which cannot be
named; ``cut`` keeps such rows as they are. Rows of one doc_id count as one document: what only they share is no
repetition. Repeats within a document alone are none either.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import materialize
from .texts import SHINGLE, blocks, byte_spans, find_words, mix, pick, seeds, shingle_hashes, word_hashes

WORDS = 50
RUN = WORDS - SHINGLE + 1
HASHES, ENOUGH = 10, 2
#: Finer keys: parts of a run whose minima make one, and hash functions in which a place must have an open window to get one.
#: The last key is all shingles of a run; in an exact copy of a run every function has such a window.
FINER = ((2, 6), (RUN, HASHES))
#: Values up to which they are broadcast instead of joined by shuffle.
FEW_VALUES = 1 << 20
#: Share of shingles that agree within a passage.
SHARE = 0.8
#: Bytes of slices that are compared at once.
SLICES = 1 << 18
#: Bytes of ids and stretches up to which they are broadcast instead of joined by shuffle.
FEW_BYTES = 32 << 20

_SEEDS = seeds(HASHES, 31)
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Block:
    """Shingles of some texts in a row, with each one's place in its text, and the texts' first and last."""

    def __init__(self, hashes: np.ndarray, begins: np.ndarray) -> None:
        sizes = np.diff(begins)
        self.hashes, self.text = hashes, np.repeat(np.arange(len(sizes)), sizes)
        self.first, self.last = begins[:-1][self.text], begins[1:][self.text] - 1
        self.place = np.arange(len(hashes)) - self.first
        # the low bits of a hash give way to the place, so that of equal ones the left one is less
        self.low = np.uint64((1 << max(24, int(sizes.max(initial=0)).bit_length())) - 1)
        self._places, self._runs = self.place.astype(np.uint64), {}

    def keyed(self, values: np.ndarray) -> np.ndarray:
        return values & ~self.low | self._places

    def runs(self, run: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether a run that begins at a place ends within its text, and whether it is the text's first; the same for all functions."""
        if run not in self._runs:
            inside = (self.place + run - 1 <= self.last - self.first)[: max(0, len(self.place) - run + 1)]
            self._runs[run] = inside, inside & (self.place[: len(inside)] == 0)
        return self._runs[run]

    @staticmethod
    def least(keyed: np.ndarray, run: int) -> np.ndarray:
        """The minimum of each ``run`` values in a row."""
        width = 1
        while 2 * width <= run:
            keyed = np.minimum(keyed[:-width], keyed[width:])
            width *= 2
        return np.minimum(keyed[: len(keyed) - run + width], keyed[run - width :]) if width < run else keyed

    def where(self, least: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where the minima are that were found for runs from ``starts``."""
        return (least & self.low).astype(np.int64) + self.first[starts]


#: Keys that go on one by one: for so few, steps of whole arrays cost more.
_LAST = 64


def _lesser_before(keys: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The nearest lesser key before each one, -1 for none; nothing before a marked begin counts."""
    found = np.where(begins, -1, np.arange(len(keys)) - 1)
    todo = np.flatnonzero(~begins)
    while len(todo) > _LAST:
        todo = todo[keys[found[todo]] > keys[todo]]
        # all between the one found and what it has found itself are greater still
        found[todo] = found[found[todo]]
        todo = todo[found[todo] >= 0]
    one_key, one_found = memoryview(keys), memoryview(found)
    for i in todo.tolist():
        key, j = one_key[i], one_found[i]
        while j >= 0 and one_key[j] > key:
            j = one_found[j]
        one_found[i] = j
    return found


def block_windows(block: Block, values: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Left ends, centres and right ends of all compact windows of at least ``run`` values, by centre."""
    inside, firsts = block.runs(run)
    if not inside.any():
        return (np.zeros(0, np.int64),) * 3
    keys = block.least(block.keyed(values), run)
    new = firsts.copy()
    new[1:] |= keys[1:] != keys[:-1]
    starts = np.flatnonzero(new & inside)
    keys = keys[starts]
    at, texts = block.where(keys, starts), block.text[starts]
    edge = texts[1:] != texts[:-1]
    before = _lesser_before(keys, np.concatenate(([True], edge)))
    after = len(at) - 1 - _lesser_before(keys[::-1], np.concatenate(([True], edge[::-1])))[::-1]
    left = np.where(before < 0, block.first[at], at[before] + 1)
    right = np.where(after == len(at), block.last[at], at[np.minimum(after, len(at) - 1)] - 1)
    return left, at, right


def compact_windows(values: np.ndarray, run: int = RUN) -> list[tuple[int, int, int]]:
    """(left, centre, right) of all compact windows of one sequence."""
    found = block_windows(Block(values, np.array([0, len(values)])), values, run)
    return list(zip(*(part.tolist() for part in found), strict=True))


def ordered_shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes in order, with the first of each text."""
    data, offsets = byte_spans(column)
    starts, ends, firsts = find_words(data, offsets)
    return shingle_hashes(word_hashes(data, starts, ends), firsts)


#: A window in one number: place, what lies left and right of it, a bit for thinned ones, and the function.
_AT, _LEFT, _RIGHT, _THIN = 1 << 22, 1 << 14, 1 << 6, 1 << 4
_REACH = 3 * RUN


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is one of the known ones, which are in order."""
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def packed(block: Block, values: np.ndarray, left: np.ndarray, at: np.ndarray, right: np.ndarray, f: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Value, text and packed window; of windows of one value within ``RUN`` places the first stands for all and is marked."""
    text, place = block.text[at], block.place[at]
    cell = place // RUN
    # one number for text, value and cell: only windows that share it can be of one value in one cell
    near = values + (text.astype(np.uint64) << np.uint64(32) | cell.astype(np.uint64)) * _ODD
    known = np.sort(near)
    known = known[1:][known[1:] == known[:-1]]
    thin = np.zeros(len(at), bool)
    if len(known):
        many = np.flatnonzero(_among(near, known))
        many = many[np.lexsort((at[many], values[many], text[many]))]
        new = np.ones(len(many), bool)
        new[1:] = np.logical_or.reduce([x[many][1:] != x[many][:-1] for x in (text, values, cell)])
        firsts = np.flatnonzero(new)
        kept, right = np.ones(len(at), bool), right.copy()
        right[many[firsts]] = np.maximum.reduceat(right[many], firsts)
        thin[many[firsts]] = np.diff(np.append(firsts, len(many))) > 1
        kept[many[~new]] = False
        values, left, at, right, text, place, thin = (x[kept] for x in (values, left, at, right, text, place, thin))
    pack = place * _AT + np.minimum(at - left, _REACH) * _LEFT + np.minimum(right - at, _REACH) * _RIGHT + thin * _THIN + f
    return values.view(np.int64), text, pack


def _rows(batch: pa.RecordBatch, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    value, text, pack = (np.concatenate(c) for c in zip(*found, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(value), batch.column("doc").take(pa.array(text)), pa.array(pack)], ["value", "doc", "pack"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in blocks(whole, "text"):
            block = Block(*ordered_shingles(batch.column("text")))
            found = []
            for f in range(HASHES):
                values = mix(block.hashes ^ _SEEDS[f])
                left, at, right = block_windows(block, values)
                found.append(packed(block, values[at], left, at, right, f))
            yield _rows(batch, found)


def _finer(parts: int):
    """Windows under the minima of ``parts`` parts of each run that holds one of the ``places``."""
    cuts = [RUN * k // parts for k in range(parts + 1)]
    # where each shingle is a part, one function is as good as all
    functions = HASHES if parts < RUN else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole, "text"):
                hashes, begins = ordered_shingles(batch.column("text"))
                block = Block(hashes, begins)
                places, sizes = batch.column("places"), np.diff(begins)
                text = np.repeat(np.arange(len(sizes)), places.value_lengths().to_numpy(zero_copy_only=False))
                place = places.flatten().to_numpy()
                # a row of the same id may be shorter than the one that a place was found in
                inside = place < sizes[text]
                open_ = np.zeros(len(hashes) + 1, np.int64)
                open_[1 + begins[text[inside]] + place[inside]] = 1
                sums = np.cumsum(open_)
                starts = np.flatnonzero(block.runs(RUN)[0])
                starts = starts[sums[starts + RUN] > sums[starts]]
                found = []
                for f in range(functions):
                    values = mix(block.hashes ^ _SEEDS[f])
                    keyed = block.keyed(values)
                    key, first, same = np.full(len(starts), _SEEDS[f]), None, np.ones(max(0, len(starts) - 1), bool)
                    least = {width: block.least(keyed, width) for width in set(np.diff(cuts).tolist())}
                    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                        at = block.where(least[b - a][starts + a], starts) if b - a > 1 else starts + a
                        first = at if first is None else first
                        same &= at[1:] == at[:-1]
                        key = mix(key + values[at])
                    new = np.flatnonzero(np.concatenate((np.ones(min(1, len(starts)), bool), ~same)))
                    # from the first run with these minima to the last one's end
                    ends = starts[np.append(new[1:], len(starts))[: len(new)] - 1] + RUN - 1
                    found.append(packed(block, key[new], starts[new], first[new], ends, f))
                yield _rows(batch, found)

    return run


def intervals(group: np.ndarray, pack: np.ndarray, o_pack: np.ndarray, enough: int) -> tuple[np.ndarray, ...]:
    """Stretches of shingles, here and in the other text, in which enough hash functions agree: group, low, high, o_low, o_high.

    ``group`` numbers the pairs of documents in ascending order.
    """
    at = pack // _AT
    apart = at - o_pack // _AT
    order = np.lexsort((apart, group))
    near = np.zeros(len(order), np.int64)
    near[1:] = (np.diff(group[order]) != 0) | (np.diff(apart[order]) > RUN)
    diagonal = np.empty_like(near)
    diagonal[order] = np.cumsum(near)
    order = np.lexsort((at, diagonal))
    group, diagonal, pack, o_pack, at, apart = (x[order] for x in (group, diagonal, pack, o_pack, at, apart))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(diagonal) != 0) | (np.diff(at) > 2 * RUN)
    firsts = np.flatnonzero(new)
    functions = np.bitwise_count(np.bitwise_or.reduceat(1 << pack % 16, firsts))
    thin = np.bitwise_or.reduceat((pack | o_pack) & _THIN, firsts) > 0
    left = np.maximum(np.minimum.reduceat(at - pack // _LEFT % 256, firsts), at[firsts] - _REACH)
    right = np.minimum(np.maximum.reduceat(at + pack // _RIGHT % 256, firsts), np.maximum.reduceat(at, firsts) + _REACH)
    if enough == 1:
        left, right = left - RUN, right + RUN  # ends of runs, not of all that agrees around them
    slack = np.where(thin, RUN, 0)
    o_left, o_right = left - np.maximum.reduceat(apart, firsts) - slack, right - np.minimum.reduceat(apart, firsts) + slack
    # widened to whole multiples, so that a document met by many has few different stretches
    low, o_low = (np.maximum(x, 0) // RUN * RUN for x in (left, o_left))
    high, o_high = (-(-(x + 1) // RUN) * RUN for x in (right, o_right))
    kept = functions >= enough
    return tuple(x[kept] for x in (group[firsts], low, high, o_low, o_high))


def _pairs(enough: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column("rows")
            flat = rows.flatten()
            group = np.repeat(np.arange(batch.num_rows), rows.value_lengths().to_numpy(zero_copy_only=False))
            which, *ends = intervals(group, flat.field("pack").to_numpy(), flat.field("o_pack").to_numpy(), enough)
            ids = [batch.column(c).take(pa.array(which)) for c in ("doc", "o_doc")]
            yield pa.RecordBatch.from_arrays([*ids, *(pa.array(e.astype(np.int32)) for e in ends)], ["doc", "o_doc", "low", "high", "o_low", "o_high"])

    return run


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Four bytes of each shingle of the wanted stretches."""
    for whole in batches:
        for batch in blocks(whole, "text"):
            hashes, begins = ordered_shingles(batch.column("text"))
            short = (hashes >> np.uint64(32)).astype(np.uint32)
            out = [
                (doc, s["low"], s["high"], short[b + s["low"] : min(b + s["high"], e)].tobytes())
                for doc, wanted, b, e in zip(batch.column("doc").to_pylist(), batch.column("wanted").to_pylist(), begins[:-1].tolist(), begins[1:].tolist(), strict=True)
                for s in wanted
                if b + s["low"] < e
            ]
            cols = zip(*out, strict=True) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], ["doc", "low", "high", "shingles"])


def agreeing(here: np.ndarray, there: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (from, to) of ``here``, at least ``RUN`` long and ``SHARE`` of them found in ``there``."""
    same = np.concatenate(([False], np.isin(here, there), [False]))
    edges = np.flatnonzero(same[1:] != same[:-1]).tolist()
    return joined(edges[::2], edges[1::2])


def joined(lows: list[int], highs: list[int]) -> list[tuple[int, int]]:
    """Stretches from runs that agree, joined from the left for as long as the share holds; ends agree."""
    out, start, end, agree = [], -1, -1, 0
    for low, high in zip(lows, highs, strict=True):
        if start >= 0 and agree + high - low >= SHARE * (high - start):
            end, agree = high, agree + high - low
            continue
        if end - start >= RUN:
            out.append((start, end))
        start, end, agree = low, high, high - low
    if end - start >= RUN:
        out.append((start, end))
    return out


def _held(rows: np.ndarray, values: np.ndarray, other_rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whether each value is among the other values of its row."""
    keys, pool = (r.astype(np.uint64) << np.uint64(32) | v for r, v in ((rows, values), (other_rows, others)))
    return _among(keys, np.sort(pool)) if len(pool) else np.zeros(len(keys), bool)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shingles of a column of slices, the row of each, and where rows begin."""
    raw, offsets = byte_spans(column)
    begins = offsets // 4
    return raw.view(np.uint32), np.repeat(np.arange(len(column)), np.diff(begins)), begins


def agreements(here: pa.Array, there: pa.Array) -> tuple[np.ndarray, ...]:
    """Row and stretch (from, to) of all that agrees in the rows, and its first and last shingle there."""
    (shingles, rows, begins), (others, other_rows, other_begins) = _lists(here), _lists(there)
    same = _held(rows, shingles, other_rows, others)
    # a False behind each row, so that no run reaches into the next one
    padded = np.zeros(len(same) + len(begins), bool)
    padded[1 + np.arange(len(same)) + rows] = same
    edges = np.flatnonzero(padded[1:] != padded[:-1])
    row = np.searchsorted(begins + np.arange(len(begins)), edges[::2], side="right") - 1
    lows, highs = (e - begins[row] - row for e in (edges[::2], edges[1::2]))
    # what does not agree in SHARE of RUN shingles has no passage
    total = np.bincount(row, highs - lows, minlength=len(begins))
    hopeful = total[row] >= SHARE * RUN
    row, lows, highs = row[hopeful], lows[hopeful], highs[hopeful]
    each, counts = np.unique(row, return_counts=True)
    lows, highs, last, found = lows.tolist(), highs.tolist(), 0, []
    for r, n in zip(each.tolist(), counts.tolist(), strict=True):
        first, last = last, last + n
        found += [(r, low, high) for low, high in joined(lows[first:last], highs[first:last])]
    row, low, high = np.array(found, np.int64).reshape(-1, 3).T
    # the same passage there: from the first to the last shingle that both have
    sizes, other_sizes = high - low, np.diff(other_begins)[row]
    at, other_at = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) for n in (sizes, other_sizes))
    which, other_which = (np.repeat(np.arange(len(row)), n) for n in (sizes, other_sizes))
    common = _held(other_which, others[other_begins[row][other_which] + other_at], which, shingles[(begins[row] + low)[which] + at])
    other_which, other_at = other_which[common], other_at[common]
    ends = np.searchsorted(other_which, np.arange(len(row) + 1))
    return row, low, high, other_at[ends[:-1]], other_at[ends[1:] - 1]


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "first_word", "n_words", "other_doc_id", "other_first_word", "other_n_words"]
    for whole in batches:
        for batch in blocks(whole, "here", SLICES):
            row, low, high, first, last = agreements(batch.column("here"), batch.column("there"))
            doc, o_doc, from_, o_from = (batch.column(c).to_numpy()[row] for c in ("doc", "o_doc", "low", "o_low"))
            columns = (doc, from_ + low, high - low + SHINGLE - 1, o_doc, o_from + first, last - first + SHINGLE)
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)


def _few(lists: DataFrame, column: str) -> DataFrame:
    """An id and a list in each row, with a hint to broadcast them if they are few by a count of all lists."""
    size = lists.agg(F.sum(24 + 8 * F.size(column))).first()[0] or 0
    return F.broadcast(lists) if size <= FEW_BYTES else lists


def _compared(named: DataFrame, pairs: DataFrame) -> DataFrame:
    """Passages of written pairs of stretches, from the texts themselves."""
    ends = pairs.select("doc", "low", "high").union(pairs.select("o_doc", "o_low", "o_high")).distinct()
    wanted = materialize(ends.groupBy("doc").agg(F.collect_set(F.struct("low", "high")).alias("wanted")), "stretches")
    slices = materialize(named.join(_few(wanted, "wanted"), "doc").mapInArrow(_slices, "doc long, low int, high int, shingles binary"), "slices")
    here = pairs.join(slices.withColumnRenamed("shingles", "here"), ["doc", "low", "high"])
    there = slices.select(F.col("doc").alias("o_doc"), F.col("low").alias("o_low"), F.col("high").alias("o_high"), F.col("shingles").alias("there"))
    both = here.join(there, ["o_doc", "o_low", "o_high"])
    columns = ", ".join(f"{c} long" for c in ("doc_id", "first_word", "n_words", "other_doc_id", "other_first_word", "other_n_words"))
    return both.select("doc", "low", "high", "here", "o_doc", "o_low", "o_high", "there").mapInArrow(_check, columns)


def _unsettled(rows: DataFrame, found: DataFrame, whole: bool = True) -> DataFrame:
    """Windows that do not lie in one passage found so far, from end to end (``whole``) or with their place alone."""
    span = F.struct(F.col("first_word").alias("low"), (F.col("first_word") + F.col("n_words") - SHINGLE).alias("high"))
    spans = found.groupBy(F.col("doc_id").alias("doc")).agg(F.collect_set(span).alias("spans"))
    at = F.shiftright("pack", _AT.bit_length() - 1)
    left, right = at - F.shiftright("pack", _LEFT.bit_length() - 1) % 256, at + F.shiftright("pack", _RIGHT.bit_length() - 1) % 256
    left, right = (left, right) if whole else (at, at)
    inside = F.exists("spans", lambda s: (left >= s["low"]) & (right <= s["high"]))
    return rows.join(spans, "doc", "left").filter(~F.coalesce(inside, F.lit(False))).drop("spans")


def _shared(windows: DataFrame, name: str) -> DataFrame:
    """Windows that more than one document has, with the smallest of these (``least``), written."""
    own = W.partitionBy("value")
    held = windows.withColumns({"least": F.min("doc").over(own), "most": F.max("doc").over(own)})
    return materialize(held.filter("least <> most").select("value", "doc", "pack", "least"), name)


def candidates(rows: DataFrame, shared: DataFrame, enough: int) -> DataFrame:
    """Pairs of stretches: windows that meet those of the smallest document of their group."""
    others = shared.filter("doc = least").select("value", F.col("doc").alias("o_doc"), F.col("pack").alias("o_pack"))
    met = rows.filter("doc > least").select("value", "doc", "pack").join(others, "value")
    held = met.groupBy("doc", "o_doc").agg(F.collect_list(F.struct("pack", "o_pack")).alias("rows"))
    if enough > 1:
        held = held.filter(F.size(F.array_distinct(F.transform("rows", lambda r: r["pack"] % 16))) >= enough)
    return held.mapInArrow(_pairs(enough), "doc long, o_doc long, low int, high int, o_low int, o_high int")


def _longest(found: DataFrame) -> DataFrame:
    """Passages without those that lie in a longer one of their document, each with the smallest document it was met in."""
    here = ["doc_id", "first_word", "n_words"]
    spans = found.groupBy(here).agg(F.min(F.struct("other_doc_id", "other_first_word", "other_n_words")).alias("there"))
    before = W.partitionBy("doc_id").orderBy("first_word", F.desc("n_words")).rowsBetween(W.unboundedPreceding, -1)
    end = F.col("first_word") + F.col("n_words")
    kept = spans.withColumn("reached", F.max(end).over(before)).filter(F.col("reached").isNull() | (end > F.col("reached")))
    return kept.select(*here, "there.*").select(found.columns)


def _cells(rows: DataFrame, functions: int) -> DataFrame:
    """Places (multiples of ``RUN``) of a document that windows of enough functions hold, with these windows' values."""
    at = F.shiftright("pack", _AT.bit_length() - 1)
    left, right = at - F.shiftright("pack", _LEFT.bit_length() - 1) % 256, at + F.shiftright("pack", _RIGHT.bit_length() - 1) % 256
    first, last = F.ceil(left / RUN), F.floor(right / RUN)
    steps = F.when(first <= last, F.sequence(first, last))
    held = rows.select("doc", "value", F.expr("shiftleft(1, int(pack % 16))").alias("f"), F.explode(steps).alias("cell"))
    cells = held.groupBy("doc", "cell").agg(F.bit_or("f").alias("fs"), F.collect_set("value").alias("values"))
    return cells.filter(F.bit_count("fs") >= functions).select("doc", (F.col("cell") * RUN).alias("place"), "values")


def _open(shared: DataFrame, found: DataFrame, functions: int, whole: bool) -> DataFrame:
    """Documents with the ``places`` that may hold a passage not yet found, and those of the documents they may share it with."""
    rows = _unsettled(shared.filter("doc > least").select("doc", "value", "pack").repartition("doc"), found, whole)
    values = materialize(_cells(rows, functions).select(F.explode("values").alias("value")).distinct(), "unsettled")
    values = F.broadcast(values) if values.count() <= FEW_VALUES else values
    rows = shared.join(values, "value", "left_semi").select("doc", "value", "pack").repartition("doc")
    return materialize(_cells(rows, functions).groupBy("doc").agg(F.collect_set("place").alias("places")), "places")


def find(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``first_word``, ``n_words`` of passages, and where the earlier document ``other_doc_id`` has them."""
    named = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc"), "text").filter("doc is not null")
    shared = _shared(named.mapInArrow(_windows, "value long, doc long, pack long"), "shared-windows")
    done = materialize(candidates(shared, shared, ENOUGH), "passages")
    found = materialize(_compared(named, done).distinct(), "found")
    for parts, functions in FINER:
        # what reaches beyond a passage found is left to the last key: most of it are mere edges
        places = _open(shared, found, functions, parts == RUN)
        if places.isEmpty():
            continue
        texts = named.join(_few(places, "places"), "doc")
        runs = _shared(texts.mapInArrow(_finer(parts), "value long, doc long, pack long"), "shared-runs")
        pairs = candidates(_unsettled(runs, found), runs, 1)
        pairs = materialize(pairs.join(done, pairs.columns, "left_anti"), "passages")
        done = done.unionByName(pairs)
        if not pairs.isEmpty():
            found = found.unionByName(materialize(_compared(named, pairs).distinct(), "found"))
    return _longest(found)


def _without(column: str):
    """Texts without the words of the stretches in ``column``; white space before a stretch goes with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column(column).to_pylist(), strict=True):
                raw = (text or "").encode()
                starts, ends, _ = find_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                kept, last = [], 0
                for s in sorted(spans, key=lambda s: (s["first_word"], s["n_words"])):
                    if s["first_word"] >= len(starts):
                        continue
                    low = int(ends[s["first_word"] - 1]) if s["first_word"] else 0
                    high = int(ends[min(s["first_word"] + s["n_words"], len(ends)) - 1])
                    if low > last:
                        kept.append(raw[last:low])
                    last = max(last, high)
                kept.append(raw[last:])
                out.append(b"".join(kept).decode().lstrip())
            names = [n for n in batch.schema.names if n != column]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if n == "text" else batch.column(n) for n in names], names)

    return run


def cut(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """``docs`` without the passages that an earlier document has; a text of which nothing is left goes as a row.

    A passage names a document by its id. Where rows of one id have different texts it is open which of them it is in,
    so these rows are left whole; copies of one row are cut alike.

    Columns stay as they are, but for ``n_chars``, which is counted anew where there is one.
    """
    own = "_stretches"
    while own in docs.columns:
        own += "_"
    spans = passages.select("doc_id", F.struct("first_word", "n_words").alias("one")).groupBy("doc_id").agg(F.collect_set("one").alias(own))
    text = F.xxhash64("text")
    several = docs.groupBy("doc_id").agg(F.min(text).alias("low"), F.max(text).alias("high")).filter("low <> high").select("doc_id")
    spans = spans.join(several, "doc_id", "left_anti")
    held = docs.join(_few(materialize(spans, "cuts"), own), "doc_id", "left").select(*[F.col(f"`{c}`") for c in docs.columns], own)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    plain = held.filter(F.col(own).isNull()).drop(own)
    less = held.filter(F.col(own).isNotNull()).mapInArrow(_without(own), columns).filter("text <> ''")
    if "n_chars" in docs.columns:
        less = less.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return plain.unionByName(less)
