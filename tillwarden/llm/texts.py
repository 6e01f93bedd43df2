"""Texts of Arrow batches as numpy arrays: bytes, words, word hashes and shingle hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that are worked on at once, so that temporary arrays stay small.
BLOCK = 1 << 20
#: Bytes of words that are hashed at once, so that their sums stay in a processor's cache.
PIECE = 1 << 15
#: Words in a shingle.
SHINGLE = 5

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (a one-to-one map)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(count: int, salt: int) -> np.ndarray:
    return mix((np.arange(count, dtype=np.uint64) + np.uint64(1)) * _ODD + np.uint64(salt))


_BYTE = seeds(256, 1)
_PLACE = seeds(SHINGLE, 2) | np.uint64(1)
_LENGTH = seeds(SHINGLE + 1, 3)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FOLDED = _BYTE[_LOWER]
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def byte_spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins and ends in them; a null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``limit`` bytes of text, one row at least."""
    _, offsets = byte_spans(batch.column(batch.schema.get_field_index(column)))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = max(first + 1, min(last, batch.num_rows))
        yield batch.slice(first, last - first)
        first = last


def find_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of runs of bytes other than blank ones, and the first word of each text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~_BLANK[data]
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    after = np.empty_like(word)
    after[-1] = False
    after[:-1] = word[1:]
    full = offsets[:-1] < offsets[1:]
    before[offsets[:-1][full]] = False
    after[offsets[1:][full] - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_POWERS: list[np.ndarray] = []


def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < length:
        base = 0xD6E8FEB86659FD93
        inverse = pow(base, -1, 1 << 64)
        _POWERS[:] = [np.cumprod(np.full(length, b, dtype=np.uint64), dtype=np.uint64) for b in (base, inverse)]
    return _POWERS[0], _POWERS[1]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word with A-Z in lower case: a polynomial in its bytes, from running sums."""
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + PIECE, side="right")))
        low, high = starts[first], ends[last - 1]
        up, down = _powers(max(PIECE, int(high - low) + 1))
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(_FOLDED[data[low:high]] * up[: high - low], out=sums[1:])
        s, e = starts[first:last] - low, ends[first:last] - low
        out[first:last] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        first = last
    return out


def shingle_hashes(words: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of five words (fewer words: all of them as one) in order, and the first run of each text."""
    counts = np.diff(firsts)
    many = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    begins = np.concatenate(([0], np.cumsum(many)))
    text = np.repeat(np.arange(len(counts)), many)
    at = firsts[:-1][text] + (np.arange(begins[-1]) - begins[:-1][text])
    left = np.minimum(firsts[1:][text] - at, SHINGLE)
    padded = np.concatenate((words, np.zeros(SHINGLE, np.uint64)))
    total = _LENGTH[left]
    for k in range(SHINGLE):
        part = padded[at + k] * _PLACE[k]
        part[left <= k] = 0
        total += part
    return mix(total), begins


def shingled(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a column of texts, with the first of each text."""
    data, offsets = byte_spans(column)
    starts, ends, firsts = find_words(data, offsets)
    return shingle_hashes(word_hashes(data, starts, ends), firsts)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that further columns of any name do no harm."""
    return df.select(*[F.col(f"`{n}`") for n in names])
