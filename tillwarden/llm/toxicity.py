"""Toxicity: a weighted lexicon, matched by Aho-Corasick on folded text, normalised by length.

Folding turns look-alike letters of other scripts into Latin ones and digits that stand for letters into them.
Entries match whole words or beginnings of words. A match inside an exception phrase does not count. The
summed weights, alone and by length, give a score through a logistic curve.

``learn`` makes lexicon and curve from labelled texts: candidates are words and beginnings of words that hardly ever
occur in clean texts; they are taken one by one, each time the one that covers most toxic texts not yet covered.
So a word that stands beside toxic words in copies of one text is not taken. Texts of the clean class that hold
an entry give exceptions: words that begin with an entry and are common among clean texts.

Null and empty texts have no matches, so the score of a text without matches. Repeated rows are scored each.
No labels, or labels of one kind only, give an empty lexicon and the share of toxic labels as score (0 without any).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .texts import blocks, mix, pick, seeds, shingled

#: Labelled texts that are learned from at most, the first in order of a hash of their id.
TRAIN_DOCS = 12_000
#: Letters of a word's beginning that may be an entry, texts it must cover, and most of them that may be clean.
PREFIXES = (4, 5, 6)
LEAST, CLEAN_SHARE = 4, 0.02
#: What a covered text counts against an uncovered one, and the count that a further entry needs.
DECAY, GAIN = 0.4, 3.0
#: Most entries.
ENTRIES = 2_000

# Cyrillic and Greek letters that look like Latin ones, and digits and signs that stand for letters.
LOOK_ALIKES = str.maketrans("асеорхуіјѕԁһкмтвнгαεικνορτυχ", "aceopxyijsdhkmtbhraeiknoptux")
STAND_INS = str.maketrans("0134578@$!", "oieastbasi")
_STANDS = re.compile(r"[0134578@$!]+")
_WORD = re.compile(r"[^\W\d_]+")


def _stand_in(found: re.Match) -> str:
    """Letters for digits and signs inside a word, and for digits that begin one."""
    text, start, end = found.string, found.start(), found.end()
    if end == len(text) or not text[end].isalpha():
        return found.group()
    inside = start > 0 and text[start - 1].isalpha()
    begins = found.group().isdigit() and (start == 0 or not text[start - 1].isalnum())
    return found.group().translate(STAND_INS) if inside or begins else found.group()


def fold(text: str) -> str:
    """Lower case, with look-alikes and stand-ins replaced."""
    text = text.lower()
    if not text.isascii():
        text = text.translate(LOOK_ALIKES)
    return _STANDS.sub(_stand_in, text)


def count_words(text: str) -> int:
    """Blanks and line ends that part words, and one."""
    return text.count(" ") + text.count("\n") + 1 if text else 0


_MARKS = seeds(8, 11)


@dataclass(frozen=True)
class Lexicon:
    """Weights of whole words and of beginnings of words, exception phrases, and the curve (base, sum, by length)."""

    words: dict[str, float] = field(default_factory=dict)
    beginnings: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)
    constant: float | None = None


def automaton(lexicon: Lexicon):
    import ahocorasick

    found: dict[str, list] = {}
    for kind, entries in (("word", lexicon.words), ("beginning", lexicon.beginnings)):
        for text, weight in entries.items():
            found.setdefault(fold(text), []).append((kind, weight))
    for text in lexicon.exceptions:
        found.setdefault(fold(text), []).append(("exception", 0.0))
    machine = ahocorasick.Automaton()
    for text, uses in found.items():
        if text:
            machine.add_word(text, (len(text), uses))
    if len(machine):
        machine.make_automaton()
    return machine


def weigh(machine, text: str) -> float:
    """Summed weights of the matches in one text; of entries that begin at one place the heaviest counts."""
    if not len(machine) or not text:
        return 0.0
    folded = fold(text)
    hits: dict[int, tuple[float, int]] = {}
    spared: list[tuple[int, int]] = []
    for end, (size, uses) in machine.iter(folded):
        start = end - size + 1
        if start and folded[start - 1].isalpha():
            continue
        closed = end + 1 == len(folded) or not folded[end + 1].isalpha()
        for kind, weight in uses:
            if kind == "exception":
                if closed:
                    spared.append((start, end))
            elif kind == "beginning" or closed:
                hits[start] = max(hits.get(start, (0.0, 0)), (weight, end))
    if spared:
        # longest-reaching exception so far, by start: inside it if that one reaches the match's end
        spared.sort()
        starts = np.array([s for s, _ in spared])
        reach = np.maximum.accumulate([e for _, e in spared])
        hits = {s: h for s, h in hits.items() if (k := int(np.searchsorted(starts, s, side="right"))) == 0 or reach[k - 1] < h[1]}
    return sum(w for w, _ in hits.values())


def _features(weight: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(weight)), np.log1p(weight), np.log1p(100 * weight / np.maximum(words, 1))], axis=1)


def _measure(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(lexicon)
        for whole in batches:
            for batch in blocks(whole, "text"):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                weight = pa.array([weigh(machine, t) for t in texts], pa.float64())
                words = pa.array([count_words(t) for t in texts], pa.int64())
                names = [n for n in batch.schema.names if n != "text"]
                yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], weight, words], [*names, "weight", "words"])

    return run


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words (marked =) and beginnings of words (marked ^) of each text, and min-hashes that tell near copies."""
    for whole in batches:
        for batch in blocks(whole, "text"):
            out = []
            hashes, firsts = shingled(batch.column("text"))
            marks = [
                np.array([mix(hashes[a:b] ^ s).min() for s in _MARKS] if a < b else [0] * len(_MARKS), np.uint64).view(np.int64)
                for a, b in zip(firsts[:-1], firsts[1:], strict=True)
            ]
            for text in batch.column("text").to_pylist():
                words = set(_WORD.findall(fold(text or "")))
                out.append(["=" + w for w in words if 3 <= len(w) <= 40] + list({"^" + w[:n] for w in words for n in PREFIXES if len(w) > n}))
            arrays = [pa.array(out, pa.list_(pa.string())), pa.array(marks, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), *arrays], ["doc_id", "label", "terms", "marks"])


def _originals(marks: dict[int, list[int]]) -> set[int]:
    """Texts without near copies of earlier ones: those that share half of their min-hashes with one."""
    seen: dict[tuple[int, int], int] = {}
    kept = set()
    for doc in sorted(marks):
        shared = Counter(seen[k] for k in enumerate(marks[doc]) if k in seen)
        if not shared or max(shared.values()) < len(marks[doc]) // 2:
            kept.add(doc)
        for k in enumerate(marks[doc]):
            seen.setdefault(k, doc)
    return kept


def _cover(rows: list[tuple[int, str]], clean: dict[str, int], toxic: int, total: int) -> dict[str, float]:
    """Entries by greedy cover of the toxic texts, with log-odds weights.

    A text counts for less the more entries it holds already, so words are still found that mostly stand beside others.
    """
    holds: dict[str, set[int]] = {}
    for doc, term in rows:
        holds.setdefault(term, set()).add(doc)
    left = {t for t, s in holds.items() if len(s) >= LEAST and clean[t] <= len(s) * CLEAN_SHARE}
    worth = {d: 1.0 for d, _ in rows}
    chosen: dict[str, float] = {}
    while left and len(chosen) < ENTRIES:
        gains = {t: sum(worth[d] for d in holds[t]) for t in left}
        left = {t for t in left if gains[t] >= GAIN}
        if not left:
            break
        best = max(left, key=lambda t: (round(gains[t], 9), len(t), t))
        chosen[best] = float(np.log((len(holds[best]) + 0.5) / (toxic + 1)) - np.log((clean[best] + 0.5) / (total - toxic + 1)))
        left.discard(best)
        # longer terms that only repeat this one go with it, and shorter ones that cover nothing more
        left = {t for t in left if not (best[0] == "^" and t[1:].startswith(best[1:]) or best[1:].startswith(t[1:]) and holds[t] <= holds[best])}
        for d in holds[best]:
            worth[d] *= DECAY
    return chosen


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton's method with a small ridge."""
    w = np.zeros(x.shape[1])
    ridge = 0.05 * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def sample_labels(labels: DataFrame, label: str, train: Column, most: int) -> DataFrame:
    """At most ``most`` labelled ids of the training part, ``doc_id`` and ``label``: the first by a hash of the id."""
    rows = labels.filter(train).select("doc_id", F.col(f"`{label}`").cast("int").alias("label"))
    return rows.filter("doc_id is not null and label is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(most)


def learn(docs: DataFrame, labels: DataFrame, train: Column, label: str = "toxic", most: int = TRAIN_DOCS) -> Lexicon:
    """Lexicon and curve from a bounded sample of labelled texts; all that reaches the driver is bounded by it."""
    chosen = F.broadcast(sample_labels(labels, label, train, most))  # at most `most` rows of two numbers
    texts = pick(docs, "doc_id", "text").join(chosen, "doc_id")
    texts = texts.dropDuplicates(["text", "label"]).persist()
    try:
        kinds = {r["label"]: r["count"] for r in texts.groupBy("label").count().collect()}
        toxic, total = kinds.get(1, 0), sum(kinds.values())
        if not toxic or toxic == total:
            return Lexicon(constant=toxic / total if total else 0.0)
        marked = texts.select("doc_id", "label", "text").mapInArrow(_terms, "doc_id long, label int, terms array<string>, marks array<long>").persist()
        first = _originals({r["doc_id"]: r["marks"] for r in marked.filter("label = 1").select("doc_id", "marks").collect()})
        terms = marked.select("doc_id", "label", F.explode("terms").alias("term"))
        counts = terms.groupBy("term").agg(F.count_if(F.col("label") == 1).alias("toxic"), F.count_if(F.col("label") == 0).alias("clean"))
        good = counts.filter((F.col("toxic") >= LEAST) & (F.col("clean") <= F.col("toxic") * CLEAN_SHARE)).persist()
        try:
            clean = {r["term"]: r["clean"] for r in good.collect()}
            rows = [(r["doc_id"], r["term"]) for r in terms.filter("label = 1").join(F.broadcast(good.select("term")), "term").select("doc_id", "term").collect()]
        finally:
            good.unpersist()
        rows, toxic = [r for r in rows if r[0] in first], len(first)
        entries = _cover(rows, clean, toxic, total)
        words = {t[1:]: w for t, w in entries.items() if t[0] == "="}
        beginnings = {t[1:]: w for t, w in entries.items() if t[0] == "^"}
        exceptions: tuple[str, ...] = ()
        if beginnings:
            longer = F.array_max(F.transform(F.array(*[F.lit(b) for b in sorted(beginnings)]), lambda b: F.startswith(F.substr("term", F.lit(2)), b)))
            spared = counts.filter(F.col("term").startswith("=") & (F.col("clean") >= LEAST) & (F.col("clean") > F.col("toxic")) & longer)
            exceptions = tuple(sorted(r["term"][1:] for r in spared.select("term").collect()))
        lexicon = Lexicon(words, beginnings, exceptions)
        seen = texts.select("label", "text").mapInArrow(_measure(lexicon), "label int, weight double, words long").toPandas()
        marked.unpersist()
    finally:
        texts.unpersist()
    curve = _fit(_features(seen["weight"].to_numpy(), seen["words"].to_numpy()), seen["label"].to_numpy().astype(float))
    return Lexicon(words, beginnings, exceptions, curve)


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``doc_id``, ``weight``, ``words`` and ``score`` (0 to 1) of each row."""
    rows = pick(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(_measure(lexicon), f"doc_id {kind}, weight double, words long")
    if lexicon.constant is not None:
        return found.withColumn("score", F.lit(lexicon.constant))
    base, by_sum, by_length = lexicon.curve
    logit = base + by_sum * F.log1p("weight") + by_length * F.log1p(100 * F.col("weight") / F.greatest("words", F.lit(1)))
    return found.withColumn("score", 1 / (1 + F.exp(-logit)))


def reject(docs: DataFrame, lexicon: Lexicon, limit: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose text scores ``limit`` or more; all columns stay."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    place = docs.columns.index("text")
    base, by_sum, by_length = lexicon.curve

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(lexicon)
        for whole in batches:
            for batch in blocks(whole, "text"):
                texts = [t or "" for t in batch.column(place).to_pylist()]
                if lexicon.constant is not None:
                    kept = np.full(len(texts), lexicon.constant < limit)
                else:
                    weight, words = np.array([weigh(machine, t) for t in texts]), np.array([count_words(t) for t in texts])
                    kept = 1 / (1 + np.exp(-(_features(weight, words) @ np.array([base, by_sum, by_length])))) < limit
                yield batch.filter(pa.array(kept))

    return docs.mapInArrow(run, columns)
