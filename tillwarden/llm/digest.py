"""Quartile bucket digests of documents: alike texts have alike digests.

Each run of three bytes of a text is hashed into one of 256 buckets. The digest says of every bucket in which
quartile of all buckets its count lies (2 bits each), and the text's length on a logarithmic scale. Two digests
differ by 0 to 3 a bucket and up to ``LENGTH_MOST`` for length; likeness is one minus the share of the most possible.

Nulls and empty texts have the digest of zero counts; texts of one or two bytes have no triplets, so only their
length shows. Equal texts have equal digests. Ties in doc_id are ordered by text hash, then by place in the input;
null ids come first. One row gives itself as its neighbour. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import materialize
from .texts import BLOCK, byte_spans, pick

BUCKETS = 256
#: Most that different lengths add to the difference, and what one step of the length code (a factor of 1.1) adds.
LENGTH_MOST, LENGTH_STEP = 96, 4
_MOST = 3 * BUCKETS + LENGTH_MOST


def bucket_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Triplet counts by text and bucket; runs do not cross from one text to the next."""
    texts = len(offsets) - 1
    if len(data) < 3:
        return np.zeros((texts, BUCKETS), dtype=np.int64)
    out = np.zeros(texts * BUCKETS, dtype=np.int64)
    for low in range(0, len(data) - 2, BLOCK):
        high = min(len(data) - 2, low + BLOCK)
        wide = data[low : high + 2].astype(np.uint32)
        code = wide[:-2] | wide[1:-1] << np.uint32(8) | wide[2:] << np.uint32(16)
        code *= np.uint32(0x9E3779B1)
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x85EBCA77)
        begin = np.arange(low, high)
        text = np.searchsorted(offsets, begin, side="right") - 1
        inside = begin + 3 <= offsets[text + 1]
        slot = text * BUCKETS + (code >> np.uint32(24))
        first = int(text[0]) * BUCKETS
        found = np.bincount(slot[inside] - first)
        out[first : first + len(found)] += found
    return out.reshape(texts, BUCKETS)


def digests(counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """One row of BUCKETS quartile codes (0 to 3) and the length code for each text."""
    ranked = np.sort(counts, axis=1)
    cuts = ranked[:, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (counts[:, :, None] > cuts[:, None, :]).sum(axis=2).astype(np.uint8)
    size = np.minimum(np.log(np.maximum(lengths, 1)) / np.log(1.1), 255).astype(np.uint8)
    return np.concatenate((size[:, None], codes), axis=1)


def hex_digests(rows: np.ndarray) -> list[str]:
    codes = rows[:, 1:].reshape(len(rows), BUCKETS // 4, 4)
    packed = (codes << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=2).astype(np.uint8)
    return [bytes([r[0]]).hex() + p.tobytes().hex() for r, p in zip(rows, packed, strict=True)]


def likeness(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """0 to 1; equal digests have 1."""
    apart = np.abs(left[:, 1:].astype(np.int16) - right[:, 1:].astype(np.int16)).sum(axis=1)
    size = np.minimum(np.abs(left[:, 0].astype(np.int16) - right[:, 0].astype(np.int16)) * LENGTH_STEP, LENGTH_MOST)
    return 1.0 - (apart + size) / _MOST


def parse(text: str) -> np.ndarray:
    """Quartile codes and length code of a digest."""
    raw = np.frombuffer(bytes.fromhex(text), np.uint8)
    return np.concatenate((raw[:1], (raw[1:, None] >> np.array([0, 2, 4, 6], dtype=np.uint8) & 3).reshape(-1)))


def fingerprint(texts: list[bytes]) -> np.ndarray:
    """Digests of texts given as UTF-8."""
    out = []
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= BLOCK):
            size += len(texts[last])
            last += 1
        lengths = np.array([len(t) for t in texts[first:last]], dtype=np.int64)
        data = np.frombuffer(b"".join(texts[first:last]), np.uint8)
        out.append(digests(bucket_counts(data, np.concatenate(([0], np.cumsum(lengths)))), lengths))
        first = last
    return np.concatenate(out) if out else np.zeros((0, BUCKETS + 1), np.uint8)


def edited(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by as many characters from the front of the following one, or all it has."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


_COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(ids: list, texts: list[str], heads: list[str]) -> dict[str, list]:
    """Result columns of texts and the texts that follow them."""
    plain = [t.encode() for t in texts]
    changed = [edited(t, h).encode() for t, h in zip(texts, heads, strict=True)]
    own, other, after = fingerprint(plain), fingerprint(changed), fingerprint([h.encode() for h in heads[-1:]])
    following = np.concatenate((own[1:], after))
    return {
        "doc_id": ids,
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t).hexdigest() for t in changed],
        "fingerprint": hex_digests(own),
        "edited_fingerprint": hex_digests(other),
        "near_edited": likeness(own, other).tolist(),
        "near_next": likeness(own, following).tolist(),
    }


_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), *[(c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")], ("near_edited", pa.float64()), ("near_next", pa.float64())]
)
_EDGE = pa.schema([*_RESULT, ("part", pa.int32()), ("first", pa.string()), ("last", pa.string())])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares the sorted rows of a partition with their successors.

    The partition's last document has its successor elsewhere; it goes out with its text, and so does the first.
    """
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    held: tuple | None = None
    head: str | None = None
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        _, offsets = byte_spans(texts)
        first = 0
        while first < len(ids):
            last = max(first + 1, min(len(ids), int(np.searchsorted(offsets, offsets[first] + BLOCK, side="right")) - 1))
            rows = list(zip(ids[first:last].to_pylist(), (t or "" for t in texts[first:last].to_pylist()), strict=True))
            first = last
            if head is None:
                head = rows[0][1]
            if held is not None:
                rows.insert(0, held)
            held = rows[-1]
            if len(rows) > 1:
                body = _compared([r[0] for r in rows[:-1]], [r[1] for r in rows[:-1]], [r[1] for r in rows[1:]])
                n = len(rows) - 1
                yield pa.RecordBatch.from_pydict(body | {"part": [None] * n, "first": [None] * n, "last": [None] * n}, schema=_EDGE)
    if held is not None:
        nothing = {c: [None] for c in _RESULT.names}
        yield pa.RecordBatch.from_pydict(nothing | {"doc_id": [held[0]], "part": [part], "first": [head], "last": [held[1]]}, schema=_EDGE)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            yield pa.RecordBatch.from_pydict(_compared([row["doc_id"]], [row["last"]], [row["head"]]), schema=_RESULT)


def compare_with_next(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """Each document's digest, that of its text with the end replaced, and how near these and the next document's are.

    Texts are shuffled once, by range of doc_id; a partition compares its rows in order and only its first and last
    text meet those of its neighbours in a second, small step.
    """
    spark = docs.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("place")
    )
    ranged = keyed.repartitionByRange(parts, "doc_id", "tie", "place").sortWithinPartitions("doc_id", "tie", "place")
    columns = f"{_COLUMNS}, part int, first string, last string"
    done = materialize(ranged.select("doc_id", "text").mapInArrow(_runs, columns), "digests")
    ends = done.filter("part is not null")
    # as many rows as there are partitions that hold anything: two numbers each
    order = W.orderBy("part")
    chain = ends.select("part", F.coalesce(F.lead("part").over(order), F.min("part").over(order)).alias("following"))
    heads = ends.select(F.col("part").alias("following"), F.col("first").alias("head"))
    tails = ends.select("part", "doc_id", "last").join(chain, "part").join(heads, "following")
    names = [c.split()[0] for c in _COLUMNS.split(", ")]
    return done.filter("part is null").select(*names).unionByName(tails.select("doc_id", "last", "head").mapInArrow(_ends, _COLUMNS))
