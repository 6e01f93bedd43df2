"""Language identification by prediction by partial matching.

For each language a tree of byte contexts up to ``ORDER`` long keeps how often each symbol followed. The code length
of a symbol is that of the longest known context: an escape for every context in which it was not seen, with the
symbols of the longer contexts excluded, then its share there. Escapes weigh as many as a context has symbols (method
C). Statistics are frozen after training, so each (context, symbol) has one exact length, worked out once. A text
gets the language with the shortest code.

Symbols are the ``SYMBOLS`` most frequent bytes of the training texts; all other bytes share one more symbol. Null texts
and texts without a letter are ``und`` with score 0. Equal lengths go to the language first by name. Without training
texts every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .texts import blocks, byte_spans, pick

ORDER = 3
SYMBOLS = 127
#: Texts that are learned from for each language, at most on average, and bytes of them all.
TRAIN_DOCS = 1_500
#: Contexts of the longest order that are kept, the most frequent of all languages.
CONTEXTS = 16_384
BLOCK = 1 << 19


@dataclass(frozen=True)
class Model:
    """``lengths`` has bits by context, symbol and language; ``places`` leads from three symbols to the context."""

    languages: list[str]
    symbols: np.ndarray  # of each byte
    places: np.ndarray
    lengths: np.ndarray


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of runs of ORDER + 1 bytes (a number of four bytes) by language."""
    for whole in batches:
        for batch in blocks(whole, "text", BLOCK):
            data, offsets = byte_spans(batch.column("text"))
            if len(data) <= ORDER:
                continue
            run = np.zeros(len(data) - ORDER, np.int64)
            for k in range(ORDER + 1):
                run = run << 8 | data[k : k + len(run)]
            at = np.arange(len(run))
            text = np.searchsorted(offsets, at, side="right") - 1
            good = at + ORDER < offsets[text + 1]
            names, kinds = np.unique(batch.column("lang").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
            keyed, counts = np.unique(kinds[text[good]].astype(np.int64) << 32 | run[good], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[keyed >> 32].tolist(), pa.string()), pa.array(keyed & 0xFFFFFFFF), pa.array(counts.astype(np.int64))], ["lang", "run", "n"]
            )


def lengths_of(counts: np.ndarray, known: list[np.ndarray], symbols: int) -> np.ndarray:
    """Bits of every symbol after each of some contexts: ``known`` has the counts after their longest to shortest suffixes.

    ``counts`` is the last resort: how often each symbol came at all.
    """
    rows = len(known[0])
    left = np.ones((rows, symbols), dtype=bool)  # symbols not yet seen in a longer context
    spent = np.zeros((rows, 1))
    bits = np.zeros((rows, symbols))
    for level in [*known, np.broadcast_to(counts, (rows, symbols))]:
        here = level * left
        total = here.sum(axis=1, keepdims=True)
        kinds = (here > 0).sum(axis=1, keepdims=True)
        more = left.sum(axis=1, keepdims=True) > kinds
        whole = total + kinds * more  # no escape when nothing is left to escape to
        seen = here > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            bits = np.where(seen, spent - np.log2(here / whole), bits)
            spent = np.where((total > 0) & more, spent - np.log2(kinds / whole), spent)
        left &= ~seen
    # symbols that never came share what is left
    rest = np.maximum(left.sum(axis=1, keepdims=True), 1)
    return np.where(left, spent + np.log2(rest), bits)


def learn(docs: DataFrame, part: Column, most: int = TRAIN_DOCS) -> Model | None:
    """Context trees of all languages from a bounded sample of the texts of the training part.

    For each language about ``most`` texts are taken, by a hash of their id. The driver gets the counts of byte runs,
    which these texts bound.
    """
    rows = pick(docs, "doc_id", "text", "lang").filter(part).filter("lang is not null and text is not null and doc_id is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return None
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, most / n))) for k, n in sorted(sizes.items())])
    sample = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < share * 1_000_003)
    grams = sample.select("lang", "text").mapInArrow(_grams, "lang string, run long, n long").groupBy("lang", "run").agg(F.sum("n").alias("n"))
    table = grams.toArrow()
    return build(
        table.column("lang").to_numpy().astype(str), table.column("run").to_numpy().astype(np.int64), table.column("n").to_numpy().astype(np.int64), sorted(sizes)
    )


def build(langs: np.ndarray, runs: np.ndarray, counts: np.ndarray, languages: list[str]) -> Model:
    """The model from counts of byte runs."""
    kind = np.searchsorted(languages, langs) if len(langs) else np.zeros(0, np.int64)
    byte = np.bincount((runs & 255).astype(np.int64), counts, minlength=256)
    ranked = np.argsort(-byte, kind="stable")
    ranked = ranked[byte[ranked] > 0][:SYMBOLS]
    symbols = np.full(256, len(ranked), np.uint8)
    symbols[ranked] = np.arange(len(ranked))
    size = len(ranked) + 1
    parts = [symbols[(runs >> (8 * k)) & 255].astype(np.int64) for k in range(ORDER, -1, -1)]  # oldest first
    last = parts[-1]
    # contexts of the longest order, by how often they came in all languages; one more row for none of them
    code = (parts[0] * size + parts[1]) * size + parts[2]
    weight = np.bincount(code, counts, minlength=size**3)
    kept = np.sort(np.argsort(-weight, kind="stable")[: min(CONTEXTS, int((weight > 0).sum()))])
    pairs = np.arange(size * size)
    # a context that is not kept falls back on its last two symbols
    places = (len(kept) + np.tile(pairs, size)).astype(np.int32)
    places[kept] = np.arange(len(kept), dtype=np.int32)
    lengths = np.empty((len(kept) + len(pairs), size, len(languages)), np.float32)
    for lang in range(len(languages)):
        own = kind == lang
        n = counts[own].astype(np.float64)

        def table(*index: np.ndarray, rows: int) -> np.ndarray:
            place = np.zeros(int(own.sum()), np.int64)
            for i in index:
                place = place * size + i[own]
            return np.bincount(place * size + last[own], n, minlength=rows * size).reshape(rows, size)

        one, two = table(parts[2], rows=size), table(parts[1], parts[2], rows=size**2)
        everywhere = np.bincount(last[own], n, minlength=size)
        at = places[code[own]].astype(np.int64)
        full = np.bincount(at * size + last[own], n, minlength=(len(kept)) * size)[: len(kept) * size].reshape(-1, size)
        for low in range(0, len(kept), 2048):
            some = kept[low : low + 2048]
            lengths[low : low + len(some), :, lang] = lengths_of(everywhere, [full[low : low + len(some)], two[some % size**2], one[some % size]], size)
        for low in range(0, len(pairs), 2048):
            some = pairs[low : low + 2048]
            lengths[len(kept) + low : len(kept) + low + len(some), :, lang] = lengths_of(everywhere, [two[some], one[some % size]], size)
    return Model(list(languages), symbols, places, lengths.reshape(-1, len(languages)))


def code_lengths(model: Model, column: pa.Array) -> np.ndarray:
    """Bits of each text in each language; the first bytes of a text stand after blanks."""
    data, offsets = byte_spans(column)
    size = round(len(model.places) ** (1 / 3))
    out = np.zeros((len(column), len(model.languages)))
    if not len(data):
        return out
    codes = model.symbols[data].astype(np.int64)
    blank = int(model.symbols[32])
    begin = np.repeat(offsets[:-1], np.diff(offsets))
    place = np.arange(len(data)) - begin
    context = np.zeros(len(data), np.int64)
    for back in (3, 2, 1):
        older = np.full(len(data), blank, np.int64)
        older[back:] = codes[:-back] if back < len(data) else codes[:0]
        context = context * size + np.where(place >= back, older, blank)
    row = model.places[context].astype(np.int64) * size + codes
    bits = model.lengths[row]
    full = np.flatnonzero(np.diff(offsets))
    out[full] = np.add.reduceat(bits, offsets[:-1][full], axis=0, dtype=np.float64)
    return out


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (how far the best language leads, as a share of all by code length) and ``bits``.

    The model has a fixed most of contexts, symbols and languages. Very long texts are summed in blocks.
    """
    rows = pick(docs, "doc_id", "text").withColumn("letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    kind = rows.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(vars(model) if model else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frozen = Model(**sent.value) if sent.value else None
        for whole in batches:
            for batch in blocks(whole, "text", BLOCK):
                letters = np.asarray(batch.column("letters").to_numpy(zero_copy_only=False), dtype=bool)
                if frozen is None:
                    best, share, least = ["und"] * batch.num_rows, np.zeros(batch.num_rows), np.zeros(batch.num_rows)
                else:
                    bits = code_lengths(frozen, batch.column("text"))
                    top = bits.argmin(axis=1)
                    least = bits[np.arange(len(bits)), top]
                    share = np.where(letters, 1 / np.exp2(-np.minimum(bits - least[:, None], 1000)).sum(axis=1), 0.0)
                    best = [frozen.languages[t] if is_text else "und" for t, is_text in zip(top, letters, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(best, pa.string()), pa.array(share, pa.float64()), pa.array(least, pa.float64())], ["doc_id", "lang_pred", "score", "bits"]
                )

    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, bits double")
