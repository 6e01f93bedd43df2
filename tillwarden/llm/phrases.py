"""Phrase collocations by vertical partitioning of suffix trees, after the ERA index.

A text is cut into pieces at punctuation and line ends, a piece into words. The suffixes of all pieces, truncated to
``longest`` words, form one tree for each language; the count of a phrase is the total of the leaves below its node.
The tree is built in parts: prefixes are packed into groups that hold about ``budget`` suffixes, a prefix with more is
extended by a word and its extensions are dealt out instead. Tasks that read the texts send each group its leaves,
already counted per block; a group's subtree is the sorted list of its leaves, and its counts are sums over runs.

Defined results: a null text is empty, a null language is ``und``; texts without words give nothing; repeated rows
count again; an empty table gives no rows; very long texts are cut into blocks at blanks, and the words behind a cut
are read along, so that no phrase is lost; equal scores are ordered by count and phrase. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .texts import _LOWER, byte_spans, mix, pick, word_hashes

#: Words of the longest phrase, and the least count of a candidate.
LONGEST, LEAST = 3, 10
#: Suffixes of a group, unless there would be more than MOST_GROUPS groups. No list sent to tasks is longer than that.
BUDGET, MOST_GROUPS = 1_000_000, 16_384
#: A candidate goes if a longer one that contains it has this share of its count, in hundredths.
COVERED = 50
#: Bytes of text that are counted at once.
BLOCK = 8 << 20
#: Leaves that a group gathers before it merges them.
GATHERED = 2_000_000
_BUCKETS = 4_096
_WORD, _BLANK, _BREAK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = _BLANK
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = _BREAK
_JOINT = b"\n"

Key = tuple[str, bytes]


@dataclass
class Plan:
    """Where leaves go. ``buckets`` has the group of each hash bucket of first words; ``hot`` the first group and the
    number of groups of each prefix that is dealt out by its next word. ``levels`` tells how many words the prefix had."""

    buckets: np.ndarray
    hot: dict[Key, tuple[int, int]] = field(default_factory=dict)
    levels: list[int] = field(default_factory=list)


@dataclass
class Words:
    """The words of a block: distinct ones, the number of each in order, and how many words of its piece follow it,
    itself included, up to the depth. Only the first ``own`` words belong to the block."""

    distinct: pa.Array
    ids: np.ndarray
    run: np.ndarray
    own: int


def _words(data: np.ndarray, own_bytes: int, depth: int) -> Words:
    kind = _KIND[data]
    inside = kind == _WORD
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece = np.cumsum(kind == _BREAK, dtype=np.int32)[starts] if len(starts) else np.zeros(0, np.int32)
    run = np.ones(len(starts), np.int8)
    for k in range(1, depth):
        run[: -k or None][piece[k:] == piece[:-k]] += 1
    places = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=places[1:])
    spelt = _LOWER[data[inside]]
    column = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(spelt)])
    coded = column.dictionary_encode()
    return Words(coded.dictionary, coded.indices.to_numpy().astype(np.int64), run, int(np.searchsorted(starts, own_bytes)))


def _cut(data: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, int]]:
    """Blocks that end between words, each with the words behind it that its last suffixes reach."""
    first = 0
    while first < len(data):
        last = first + BLOCK
        if last < len(data):
            gaps = np.flatnonzero(_KIND[data[first:last]])
            if len(gaps):
                last = first + int(gaps[-1]) + 1
            while last < len(data) and _KIND[data[last]] == _WORD and _KIND[data[last - 1]] == _WORD:
                last += 1
        last = min(last, len(data))
        reach, more = last, 0
        while reach < len(data) and more < depth:
            kind = _KIND[data[reach]]
            more = depth if kind == _BREAK else more + (kind == _BLANK and _KIND[data[reach - 1]] == _WORD)
            reach += 1
        yield data[first:reach], last - first
        first = last


def _blocks(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[tuple[str, Words]]:
    """The words of each language's texts in blocks."""
    held: dict[str, list[bytes]] = {}
    size = 0

    def flush() -> Iterator[tuple[str, Words]]:
        for lang, texts in held.items():
            for data, own in _cut(np.frombuffer(_JOINT.join(texts), np.uint8), depth):
                yield lang, _words(data, own, depth)

    for batch in batches:
        raw, offsets = byte_spans(batch.column(1))
        for i, lang in enumerate(batch.column(0).to_pylist()):
            held.setdefault(lang, []).append(raw[offsets[i] : offsets[i + 1]].tobytes())
            size += int(offsets[i + 1] - offsets[i]) + 1
            if size >= BLOCK:
                yield from flush()
                held, size = {}, 0
    yield from flush()


def _texts(docs: DataFrame) -> DataFrame:
    return pick(docs, "lang", "text").select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``phrase`` and ``n`` of each word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in _blocks(batches, 1):
            n = np.bincount(words.ids[: words.own], minlength=len(words.distinct))
            yield pa.record_batch({"lang": pa.repeat(lang, len(n)), "phrase": words.distinct.cast(pa.string()), "n": pa.array(n)})

    counted = _texts(docs).mapInArrow(count, "lang string, phrase string, n long")
    return counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _distinct(rows: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct rows of word numbers and their counts."""
    if not len(rows):
        return rows, np.zeros(0, np.int64)
    bits = max(1, int(rows.max()).bit_length())
    per = 63 // bits
    columns = []
    for first in range(0, rows.shape[1], per):
        packed = np.zeros(len(rows), np.int64)
        for k in range(first, min(first + per, rows.shape[1])):
            packed = (packed << bits) | rows[:, k]
        columns.append(packed)
    order = np.argsort(columns[0]) if len(columns) == 1 else np.lexsort(columns[::-1])
    new = np.zeros(len(rows), bool)
    new[0] = True
    for c in columns:
        s = c[order]
        new[1:] |= s[1:] != s[:-1]
    firsts = np.flatnonzero(new)
    if counts is None:
        total = np.diff(np.append(firsts, len(rows)))
    else:
        total = np.add.reduceat(counts[order], firsts)
    return rows[order[firsts]], total


def _leaves(words: Words, depth: int, which: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of the block's own words (or of those marked), cut to the depth: word numbers from 1, 0 behind the end."""
    at = np.arange(words.own) if which is None else np.flatnonzero(which[: words.own])
    rows = np.zeros((len(at), depth), np.int64)
    for k in range(depth):
        there = words.run[at] > k
        rows[there, k] = words.ids[at[there] + k] + 1
    return _distinct(rows)


def _hashes(lang: str, distinct: pa.Array) -> np.ndarray:
    data, offsets = byte_spans(distinct)
    salt = np.uint64(hash_of(lang))
    return np.concatenate((np.zeros(1, np.uint64), mix(word_hashes(data, offsets[:-1], offsets[1:]) ^ salt)))


def hash_of(text: str) -> int:
    """A 64-bit value of a short text, the same in every process."""
    value = 1469598103934665603
    for byte in text.encode():
        value = ((value ^ byte) * 1099511628211) & ((1 << 64) - 1)
    return value


def _numbers(lang: str, words: Words, wanted: dict[Key, tuple]) -> dict[tuple[int, ...], tuple]:
    """Prefixes of the list that a block can hold, by its word numbers."""
    mine = {tuple(prefix.split(b" ")): v for (of, prefix), v in wanted.items() if of == lang}
    if not mine:
        return {}
    spelt = pa.array(sorted({w for prefix in mine for w in prefix}), pa.binary())
    found = pc.index_in(spelt, words.distinct).to_pylist()
    number = {w: i + 1 for w, i in zip(spelt.to_pylist(), found) if i is not None}
    return {tuple(number[w] for w in prefix): v for prefix, v in mine.items() if all(w in number for w in prefix)}


def _marks(rows: np.ndarray, prefixes: dict[tuple[int, ...], tuple]) -> Iterator[tuple[tuple, np.ndarray]]:
    """For each prefix of the list the range of the sorted rows that begin with it."""
    for prefix, value in prefixes.items():
        low, high = 0, len(rows)
        for k, number in enumerate(prefix):
            column = rows[low:high, k]
            low, high = low + int(np.searchsorted(column, number)), low + int(np.searchsorted(column, number, side="right"))
        if low < high:
            yield value, np.arange(low, high), len(prefix)


def _extended(docs: DataFrame, hot: list[Key]) -> DataFrame:
    """Counts of the extensions of the given prefixes by a word."""
    wanted = {key: (key[1],) for key in hot}
    depth = hot[0][1].count(b" ") + 2

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in _blocks(batches, depth):
            prefixes = _numbers(lang, words, wanted)
            first = np.zeros(len(words.distinct) + 1, bool)
            first[[p[0] for p in prefixes]] = True
            rows, n = _leaves(words, depth, first[words.ids + 1])
            spelt = words.distinct
            for (prefix,), at, _ in _marks(rows, prefixes):
                at = at[rows[at, -1] > 0]
                last = spelt.take(pa.array(rows[at, -1] - 1)).cast(pa.string())
                phrase = pc.binary_join_element_wise(prefix.decode(), last, " ")
                yield pa.record_batch({"lang": pa.repeat(lang, len(at)), "phrase": phrase, "n": pa.array(n[at])})

    return _texts(docs).mapInArrow(count, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _bucket(words: DataFrame) -> DataFrame:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_pylist()
            out = np.zeros(len(langs), np.int32)
            for lang in set(langs):
                mine = np.array([x == lang for x in langs])
                out[mine] = _hashes(lang, batch.column(1).filter(pa.array(mine)))[1:] % np.uint64(_BUCKETS)
            yield pa.record_batch({"bucket": pa.array(out), "n": batch.column(2)})

    return pick(words, "lang", "phrase", "n").mapInArrow(place, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def plan(docs: DataFrame, words: DataFrame, longest: int = LONGEST, budget: int = BUDGET) -> Plan:
    """Packs prefixes into groups. Longer prefixes are counted only where a shorter one exceeds the budget."""
    total = words.agg(F.sum("n")).first()[0] or 0
    budget = max(budget, -(-total // MOST_GROUPS))
    over = F.col("n") > budget
    made = Plan(np.zeros(_BUCKETS, np.int64))
    weight = np.zeros(_BUCKETS, np.int64)
    for bucket, n in _bucket(words.filter(~over)).collect():
        weight[bucket] = n
    held = 0
    for i, n in enumerate(weight.tolist()):
        if not made.levels or held + n > budget:
            made.levels.append(0)
            held = 0
        held += n
        made.buckets[i] = len(made.levels) - 1
    counts = words
    for level in range(1, longest):
        hot = [((r.lang, r.phrase.encode()), r.n) for r in counts.filter(over).collect()]
        if not hot:
            break
        for key, n in sorted(hot):
            made.hot[key] = (len(made.levels), -(-n // budget))
            made.levels.extend([level] * made.hot[key][1])
        if level + 1 < longest:
            counts = materialize(_extended(docs, [key for key, _ in hot]).filter(over), "prefixes")
    return made


_LEAVES = "group int, lang string, words binary, leaves binary, counts binary"


def _squeezed(array: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(array).tobytes(), codec="zstd", asbytes=True)


def _pack(group: int, lang: str, distinct: pa.Array, rows: np.ndarray, n: np.ndarray) -> dict:
    """A block's leaves of a group: the words that they use, and the rows column by column."""
    used, numbers = np.unique(rows, return_inverse=True)
    if used[0] != 0:
        used, numbers = np.append(0, used), numbers + 1
    spelt = _JOINT.join(distinct.take(pa.array(used[1:] - 1)).to_pylist())
    numbers = numbers.reshape(rows.shape).astype(np.uint32)
    sizes = [len(rows), len(spelt)]
    leaves = np.array(sizes, np.int64).tobytes() + _squeezed(numbers.T)
    return {"group": group, "lang": lang, "words": pa.compress(spelt, codec="zstd", asbytes=True), "leaves": leaves, "counts": _squeezed(n.astype(np.int64))}


def _unpack(row: dict, depth: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    many, length = np.frombuffer(row["leaves"][:16], np.int64).tolist()
    spelt = pa.decompress(row["words"], decompressed_size=length, codec="zstd", asbytes=True).split(_JOINT)
    raw = pa.decompress(row["leaves"][16:], decompressed_size=many * depth * 4, codec="zstd", asbytes=True)
    n = pa.decompress(row["counts"], decompressed_size=many * 8, codec="zstd", asbytes=True)
    return pa.array(spelt, pa.binary()), np.frombuffer(raw, np.uint32).reshape(depth, many).T.astype(np.int64), np.frombuffer(n, np.int64)


def _deal(made: Plan, depth: int):
    """Reads texts and sends each group its leaves of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in _blocks(batches, depth):
            rows, n = _leaves(words, depth)
            if not len(rows):
                continue
            hashes = _hashes(lang, words.distinct)
            group = made.buckets[(hashes[rows[:, 0]] % np.uint64(_BUCKETS)).astype(np.int64)]
            for (base, many), at, level in sorted(_marks(rows, _numbers(lang, words, made.hot)), key=lambda m: m[2]):
                group[at] = base + (hashes[rows[at, level]] % np.uint64(many)).astype(np.int64)
            order = np.argsort(group, kind="stable")
            cuts = np.flatnonzero(np.diff(group[order])) + 1
            out = [_pack(int(group[at[0]]), lang, words.distinct, rows[at], n[at]) for at in np.split(order, cuts)]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("group", pa.int32()), ("lang", pa.string()), ("words", pa.binary()), ("leaves", pa.binary()), ("counts", pa.binary())]))

    return run


def _merge(parts: list) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Leaves of several blocks as one sorted list over common word numbers."""
    coded = pa.concat_arrays([p[0] for p in parts]).dictionary_encode()
    numbers = np.concatenate((np.zeros(1, np.int64), coded.indices.to_numpy().astype(np.int64) + 1))
    rows, first = [], 0
    for spelt, own, _ in parts:
        rows.append(np.where(own > 0, numbers[own + first], 0))
        first += len(spelt)
    return coded.dictionary, *_distinct(np.concatenate(rows), np.concatenate([p[2] for p in parts]))


def _read_counts(lang: str, level: int, parts: list, depth: int, least: int) -> pa.RecordBatch:
    """Counts of the phrases of a subtree from its leaves. Those that other groups share are given whatever they are."""
    distinct, rows, n = _merge(parts)
    phrases, counts = [], []
    new = np.zeros(len(rows), bool)
    new[:1] = True
    for k in range(depth):
        new[1:] |= rows[1:, k] != rows[:-1, k]
        if k == 0:
            continue
        firsts = np.flatnonzero(new)
        total = np.add.reduceat(n, firsts)
        keep = (rows[firsts, k] > 0) & ((total >= least) | (k < level))
        at = firsts[keep]
        spelt = [distinct.take(pa.array(rows[at, j] - 1)).cast(pa.string()) for j in range(k + 1)]
        phrases.append(pc.binary_join_element_wise(*spelt, " "))
        counts.append(pa.array(total[keep], pa.int64()))
    phrase = pa.concat_arrays(phrases)
    return pa.record_batch({"lang": pa.repeat(lang, len(phrase)), "phrase": phrase, "n": pa.concat_arrays(counts)})


def _build(levels: list[int], depth: int, least: int):
    """One subtree after the other from the sorted rows of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, gathered = None, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                own = (row["group"], row["lang"])
                if own != key and parts:
                    yield _read_counts(key[1], levels[key[0]], parts, depth, least)
                    parts, gathered = [], 0
                key = own
                parts.append(_unpack(row, depth))
                gathered += len(parts[-1][1])
                if gathered > GATHERED and len(parts) > 1:
                    parts = [_merge(parts)]
                    gathered = 0  # what is merged stays; only new leaves count towards the next merge
        if parts:
            yield _read_counts(key[1], levels[key[0]], parts, depth, least)

    return run


def count_phrases(docs: DataFrame, words: DataFrame, longest: int = LONGEST, least: int = LEAST, budget: int = BUDGET) -> DataFrame:
    """``lang``, ``phrase`` and ``n`` of the phrases of 2 to ``longest`` words that occur ``least`` times or more."""
    made = plan(docs, words, longest, budget)
    dealt = _texts(docs).mapInArrow(_deal(made, longest), _LEAVES)
    grouped = dealt.repartitionById(len(made.levels), F.col("group")).sortWithinPartitions("group", "lang")
    found = grouped.mapInArrow(_build(made.levels, longest, least), "lang string, phrase string, n long")
    # A prefix that was dealt out has a row in each of its groups.
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _wide(column: Column) -> Column:
    return column.cast("decimal(15,0)")


def score_cuts(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """Each phrase with its lowest-scoring cut: ``a``, ``l``, ``r`` and ``score``, by decimal arithmetic without rounding."""
    counts = words.unionByName(phrases)
    split = phrases.withColumn("_w", F.split("phrase", " "))
    cuts = split.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("_w") - 1))).select(
        "lang",
        "phrase",
        F.col("n").alias("a"),
        "k",
        F.array_join(F.slice("_w", F.lit(1), F.col("k")), " ").alias("_first"),
        F.array_join(F.slice("_w", F.col("k") + 1, F.size("_w")), " ").alias("_rest"),
    )
    for part, name in (("_first", "l"), ("_rest", "r")):
        side = counts.select("lang", F.col("phrase").alias(part), F.col("n").alias(name))
        cuts = cuts.join(side, ["lang", part])
    above = _wide(F.col("a")) * _wide(F.col("a")) * F.lit(1_000_000).cast("decimal(7,0)")
    below = _wide(F.col("l")) * _wide(F.col("r"))
    scored = cuts.withColumns({"_above": above, "_below": below}).withColumn("score", F.expr("_above div _below"))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("_c"))
    return lowest.select("lang", "phrase", "_c.a", "_c.l", "_c.r", "_c.score")


def covering(phrases: DataFrame) -> DataFrame:
    """``_most``: the largest count of a longer phrase that holds the phrase."""
    split = phrases.withColumn("_w", F.split("phrase", " ")).withColumn("_s", F.size("_w")).filter("_s > 2")
    sized = split.withColumn("_k", F.explode(F.sequence(F.lit(2), F.col("_s") - 1)))
    inner = sized.withColumn("_at", F.explode(F.sequence(F.lit(1), F.col("_s") - F.col("_k") + 1)))
    part = F.array_join(F.slice("_w", F.col("_at"), F.col("_k")), " ")
    return inner.select("lang", part.alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("_most"))


def mine(docs: DataFrame, top: int = 2_000, longest: int = LONGEST, least: int = LEAST, budget: int = BUDGET) -> DataFrame:
    """The best ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    words = materialize(word_counts(docs), "words")
    phrases = materialize(count_phrases(docs, words, longest, least, budget), "phrases")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = words.filter(F.col("n") >= least)
    scored = score_cuts(frequent, phrases).join(covering(phrases), ["lang", "phrase"], "left")
    kept = scored.filter(F.col("_most").isNull() | (100 * F.col("_most") < COVERED * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
