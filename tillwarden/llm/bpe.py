"""Byte-level BPE with given ranks: encoding by overlapping chunks, decoding by joining raw bytes.

A text longer than a chunk is cut into chunks that overlap. Each chunk is split into pre-tokens from its own start,
wherever that lies. Splitting only looks forward, so from the first place in an overlap at which both neighbours
begin a pre-token, both go on alike: there the chunks are stitched, and the stretches between stitches are
encoded apart from each other, in any order, on any executor. Stitches follow a character that is not white
space, so a stretch's end never changes how the white space before it is split. If some overlap has no such place
(one pre-token longer than the overlap), the text is encoded in one piece, which gives the same ids.

Nulls and empty texts have no ids. Rows with equal or null ids stay apart. Special tokens are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .texts import blocks, pick

#: Code points of a chunk's own part, and of what it shares with the next one.
CHUNK, OVERLAP = 16_384, 512
#: Bytes of text that are encoded before their ids are handed on.
BATCH = 1 << 19


def read_ranks(path: str) -> list[bytes]:
    """Byte strings in the order of their ranks, of a vocabulary file of the tiktoken kind."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    table: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        table[int(rank)] = base64.b64decode(token)
    return table


def ship_ranks(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary, read once by the driver; a file of some hundred KB that does not depend on the data."""
    return spark.sparkContext.broadcast(read_ranks(path))


_CODERS: dict = {}


def coder(table: list[bytes], pattern: str):
    import tiktoken

    key = (id(table), pattern)
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(table)}, special_tokens={})
    return _CODERS[key]


def _compiled(pattern: str):
    import regex

    return regex.compile(pattern)  # which keeps compiled patterns


def boundaries(text: str, pattern: str) -> np.ndarray:
    """Places where pre-tokens begin that follow no white space; the text's end is none."""
    return np.array([m.start() for m in _compiled(pattern).finditer(text) if m.start() and not text[m.start() - 1].isspace()], dtype=np.int32)


def stitch(heads: np.ndarray, tails: np.ndarray) -> int | None:
    """The first place that both neighbours have, if any."""
    both = np.intersect1d(heads, tails)
    return int(both[0]) if len(both) else None


class Bytes:
    """Token bytes one after the other, to join the bytes of many ids at once."""

    def __init__(self, table: list[bytes]):
        self.data = np.frombuffer(b"".join(table), np.uint8)
        self.size = np.array([len(t) for t in table], dtype=np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.size)))[:-1]

    def join(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        ends = np.cumsum(size)
        if not len(ids):
            return np.zeros(0, np.uint8)
        shift = np.repeat(self.start[ids] - (ends - size), size)
        return self.data[shift + np.arange(ends[-1])]


def _encoder(ranks: Broadcast, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(ranks.value, pattern)
        for whole in batches:
            for batch in blocks(whole, "text", BATCH):
                found = [code.encode_ordinary(t or "") for t in batch.column("text").to_pylist()]
                ends = np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32)
                flat = np.fromiter((i for f in found for i in f), dtype=np.int32, count=int(ends[-1]))
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                names = [n for n in batch.schema.names if n != "text"]
                yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], ids], [*names, "ids"])

    return run


def _cut(pattern: str, chunk: int, overlap: int):
    """Chunks of texts with the places near both ends at which their pre-tokens begin, counted from the text's start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("text").to_pylist()):
                key = batch.slice(i, 1)
                # the last chunk reaches the end, so that no chunk lies within an overlap
                for k, start in enumerate(range(0, max(1, len(text) - overlap), chunk)):
                    part = text[start : start + chunk + overlap]
                    places = boundaries(part, pattern)
                    heads, tails = places[places < overlap] + start, places[places >= chunk] + start
                    yield pa.RecordBatch.from_arrays(
                        [
                            key.column("row"),
                            key.column("doc_id"),
                            *[pa.array([n], pa.int32()) for n in (k, start)],
                            pa.array([part], pa.string()),
                            *[pa.array([n], pa.list_(pa.int32())) for n in (heads, tails)],
                        ],
                        ["row", "doc_id", "k", "start", "text", "heads", "tails"],
                    )

    return run


def round_trip(docs: DataFrame, ranks: Broadcast, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded`` as ``encode`` and ``decode`` give them.

    Short texts are decoded in the worker that encodes them, so that a task needs one Python worker.
    """
    plain, long = _halves(docs, ranks, pattern, chunk, overlap, True)
    return plain.unionByName(decode(long, ranks))


def encode(docs: DataFrame, ranks: Broadcast, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of each row's whole text."""
    plain, long = _halves(docs, ranks, pattern, chunk, overlap, False)
    return plain.unionByName(long)


def _halves(docs: DataFrame, ranks: Broadcast, pattern: str, chunk: int, overlap: int, decoded: bool) -> tuple[DataFrame, DataFrame]:
    """Short texts, ``decoded`` too if asked for, and long ones."""
    rows = pick(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    short = F.coalesce(F.length("text"), F.lit(0)) <= chunk
    run = _encoder(ranks, pattern)
    if decoded:
        back = _decoder(ranks)
        plain = rows.filter(short).mapInArrow(lambda batches: back(run(batches)), f"doc_id {kind}, ids array<int>, decoded binary")
    else:
        plain = rows.filter(short).mapInArrow(run, f"doc_id {kind}, ids array<int>")
    # long texts: the chunks are dealt out before the costly part
    long = rows.filter(~short).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    chunks = long.mapInArrow(
        _cut(pattern, chunk, overlap), f"row long, doc_id {kind}, k int, start int, text string, heads array<int>, tails array<int>"
    )
    order, every = W.partitionBy("row").orderBy("k"), W.partitionBy("row")
    met = F.array_min(F.array_intersect(F.lag("tails").over(order), "heads"))
    seen = chunks.withColumn("at", F.when(F.col("k") == 0, 0).otherwise(met))
    seen = seen.withColumns(
        {"until": F.lead("at").over(order), "last": F.col("k") == F.max("k").over(every), "apart": F.max(F.col("at").isNull()).over(every)}
    )
    size = F.when(F.col("last"), F.length("text")).when(F.col("apart"), F.lit(chunk)).otherwise(F.col("until") - F.col("at"))
    begin = F.when(F.col("apart"), F.lit(1)).otherwise(F.col("at") - F.col("start") + 1)
    parts = seen.withColumn("text", F.substring("text", begin, size))
    ordered = F.array_sort(F.collect_list(F.struct("k", "text")))
    whole = parts.filter("apart").groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.array_join(F.transform(ordered, lambda x: x["text"]), "").alias("text")
    )
    pieces = parts.filter("not apart").select("row", "doc_id", "k", "text").unionByName(whole.withColumn("k", F.lit(0)))
    coded = pieces.mapInArrow(run, f"row long, doc_id {kind}, k int, ids array<int>")
    ordered = F.array_sort(F.collect_list(F.struct("k", "ids")))
    joined = coded.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.flatten(F.transform(ordered, lambda x: x["ids"])).alias("ids"))
    return plain, joined.select("doc_id", "ids")


def _decoder(ranks: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Bytes(ranks.value)
        for batch in batches:
            ids = batch.column("ids")
            ends = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1].astype(np.int64)
            flat = np.asarray(ids.values)
            first = 0
            while first < len(ids):
                step = max(first + 1, min(len(ids), int(np.searchsorted(ends, ends[first] + BATCH, side="right")) - 1))
                own = flat[ends[first] : ends[step]]
                data = table.join(own)
                sizes = np.concatenate(([0], np.cumsum(table.size[own])))
                places = sizes[ends[first : step + 1] - ends[first]].astype(np.int32)
                text = pa.Array.from_buffers(pa.binary(), step - first, [None, pa.py_buffer(places.tobytes()), pa.py_buffer(data.tobytes())])
                piece = batch.slice(first, step - first)
                yield pa.RecordBatch.from_arrays([*piece.columns, text], [*piece.schema.names, "decoded"])
                first = step

    return run


def decode(coded: DataFrame, ranks: Broadcast) -> DataFrame:
    """Adds ``decoded`` (binary): the bytes of all ids of a row, joined."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema)
    return coded.mapInArrow(_decoder(ranks), f"{columns}, decoded binary")
