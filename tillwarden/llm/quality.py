"""Quality classifier: supervised subword embeddings.

A text is the average of learned vectors of its hashed features: words, n-grams of 3 to 5 bytes of words with their
edges, and a feature for a word that repeats the one before. A softmax over this average gives the class.
Vectors and output weights are trained by stochastic gradient descent in numpy on a bounded sample of labelled
texts. Since the output is linear in the average, a trained model is kept as one logit difference per feature.

Null and empty texts have no features and score by the bias alone. Repeated rows are scored each. Without labels the
score is 0.5; with one kind of label only, it is that label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .texts import BLOCK, blocks, byte_spans, find_words, mix, pick, word_hashes
from .toxicity import sample_labels

#: Labelled texts that are learned from at most.
TRAIN_DOCS = 5_000
#: Rows of the feature table, and numbers in a vector.
FEATURES, SIZE = 1 << 17, 12
GRAMS = (3, 4, 5)
EPOCHS, RATE, SEED = 6, 0.6, 7

_REPEAT = FEATURES - 1


def _edges(data: np.ndarray) -> np.ndarray:
    """Bytes with every blank as one and the same edge mark."""
    plain = data.copy()
    plain[(data >= 9) & (data <= 13)] = 32
    return plain


def feature_ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature of every word, n-gram and repetition of a block of texts, and the text each is in (not in order)."""
    data, offsets = byte_spans(column)
    starts, ends, firsts = find_words(data, offsets)
    word_text = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
    words = word_hashes(data, starts, ends)
    shape = np.zeros(len(words), np.uint64)
    if len(words):
        # capitals tell much about quality, while the word hash ignores them
        upper = np.concatenate(([0], np.cumsum((data >= 65) & (data <= 90))))
        shape = np.minimum(upper[ends] - upper[starts], 3).astype(np.uint64)
    ids, texts = [(mix(words + shape) % np.uint64(FEATURES - 1)).astype(np.int32)], [word_text]
    same = np.flatnonzero((words[1:] == words[:-1]) & (word_text[1:] == word_text[:-1]))
    ids.append(np.full(len(same), _REPEAT, np.int32))
    texts.append(word_text[same])
    plain = _edges(data)
    blank = np.concatenate(([0], np.cumsum(plain == 32)))
    for n in GRAMS:
        count = len(plain) - n + 1
        if count <= 0:
            continue
        code = np.full(count, n, np.uint64)
        for k in range(n):
            code *= np.uint64(0x100000001B3)
            code ^= plain[k : k + count]
        # blanks may stand at the edges of an n-gram, not inside
        inner = blank[n - 1 : n - 1 + count] - blank[1 : 1 + count]
        at = np.arange(count)
        text = np.searchsorted(offsets, at, side="right") - 1
        good = (inner == 0) & (at + n <= offsets[text + 1])
        code = code[good]
        code ^= code >> np.uint64(29)
        code *= np.uint64(0x9E3779B97F4A7C15)
        ids.append(((code >> np.uint64(32)) % np.uint64(FEATURES - 1)).astype(np.int32))
        texts.append(text[good])
    return np.concatenate(ids), np.concatenate(texts)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct features of each text with their shares."""
    for whole in batches:
        for batch in blocks(whole, "text"):
            ids, texts = feature_ids(batch.column("text"))
            order = np.argsort(texts, kind="stable")
            ids, cuts = ids[order], np.searchsorted(texts[order], np.arange(batch.num_rows + 1))
            bags = [np.unique(ids[a:b], return_counts=True) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array([b[0] for b in bags], pa.list_(pa.int32())), pa.array([b[1] / max(1, b[1].sum()) for b in bags], pa.list_(pa.float32()))],
                ["label", "ids", "shares"],
            )


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Logit difference of each feature, and the bias, after gradient descent over the texts one by one."""
    rng = np.random.default_rng(SEED)
    table = rng.uniform(-1 / SIZE, 1 / SIZE, (FEATURES, SIZE)).astype(np.float32)
    out = np.zeros((2, SIZE), np.float32)
    bias = np.log(np.bincount(labels, minlength=2) + 1.0).astype(np.float32)
    weight = len(labels) / (2.0 * np.maximum(np.bincount(labels, minlength=2), 1))
    steps, done = EPOCHS * len(labels), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(labels)):
            ids, shares = bags[i]
            rate = RATE * (1 - done / steps) * min(weight[labels[i]], 4.0)
            done += 1
            if not len(ids):
                continue
            rows = table[ids]
            hidden = shares @ rows
            logits = out @ hidden + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            pull = p @ out
            out -= rate * np.outer(p, hidden)
            # every feature moves by its share of the largest, so that frequent ones lead
            table[ids] = rows - rate * (shares / shares.max())[:, None] * pull
    return table @ (out[1] - out[0]), float(bias[1] - bias[0])


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float


def learn(docs: DataFrame, labels: DataFrame, part: Column, label: str = "quality", most: int = TRAIN_DOCS) -> Model:
    """A model from at most ``most`` labelled texts of the training part; their features go to the driver."""
    chosen = F.broadcast(sample_labels(labels, label, part, most))  # at most `most` rows of two numbers
    texts = pick(docs, "doc_id", "text").join(chosen, "doc_id").select("label", "text")
    found = texts.mapInArrow(_bags, "label int, ids array<int>, shares array<float>").toArrow()
    kinds = np.asarray(found.column("label").combine_chunks(), dtype=np.int64) if found.num_rows else np.zeros(0, np.int64)
    if not len(kinds) or kinds.min() == kinds.max():
        return Model(np.zeros(FEATURES, np.float32), 0.0 if not len(kinds) else 40.0 * (2 * int(kinds[0]) - 1))
    bags = [
        (i.values.to_numpy(), s.values.to_numpy()) for i, s in zip(found.column("ids"), found.column("shares"), strict=True)
    ]
    # the order of arrival differs between runs; training must not
    keys = [(int(k), len(b[0]), b[0].tobytes(), b[1].tobytes()) for k, b in zip(kinds, bags, strict=True)]
    order = sorted(range(len(keys)), key=keys.__getitem__)
    weights, bias = train([bags[i] for i in order], kinds[order])
    return Model(weights.astype(np.float32), bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score``: the probability of class 1 for each row. The broadcast model is a table of fixed size."""
    rows = pick(docs, "doc_id", "text")
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = sent.value
        for whole in batches:
            for batch in blocks(whole, "text", BLOCK):
                ids, texts = feature_ids(batch.column("text"))
                total = np.bincount(texts, weights[ids], minlength=batch.num_rows)
                count = np.bincount(texts, minlength=batch.num_rows)
                logit = total / np.maximum(count, 1) + bias
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(logit, -60, 60))))], ["doc_id", "score"])

    return rows.mapInArrow(run, f"doc_id {kind}, score double")
