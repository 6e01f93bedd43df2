"""Phrase mining against counts by plain loops."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwarden.llm import phrases


def brute(rows, top, longest, least):
    f = defaultdict(Counter)
    for lang, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", text):
            w = re.findall(r"[^ \t]+", piece)
            for i in range(len(w)):
                for k in range(1, min(longest, len(w) - i) + 1):
                    f[lang or "und"][tuple(w[i : i + k])] += 1
    out = []
    for lang, c in f.items():
        n = sum(v for p, v in c.items() if len(p) == 1)
        cands = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        dropped = set()
        for p, a in cands.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if 100 * a >= 50 * cands[p[i : i + k]]:
                        dropped.add(p[i : i + k])
        scored = []
        for p, a in cands.items():
            if p not in dropped:
                score, k = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string").withColumns({"phrase": F.lit(1), "n": F.lit("x"), "group": F.lit(2)})


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    names = ["The", "of", "É", "rend", "x-y", "a", "b", "c d", "ß", "q"]
    texts = []
    for i in range(120):
        words = rng.choice(names, size=rng.integers(0, 40), p=[0.4, 0.2, 0.1, 0.1, 0.05, 0.05, 0.04, 0.03, 0.02, 0.01])
        ends = rng.choice([" ", "  ", "\t", ", ", ".", "\n", "\x0b"], size=len(words), p=[0.6, 0.1, 0.1, 0.1, 0.04, 0.03, 0.03])
        texts.append((["en", "fr", None][i % 3], "".join(w + e for w, e in zip(words, ends))))
    return [*texts, ("en", None), ("fr", ""), (None, " , . "), texts[0], texts[0]]


@pytest.mark.parametrize("budget", [7, 60, 10**6])
@pytest.mark.parametrize("longest", [3, 4])
def test_mine(spark, rows, budget, longest):
    found = phrases.mine(frame(spark, rows), top=25, longest=longest, least=4, budget=budget)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 25, longest, 4)


def test_small_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK", 50)
    monkeypatch.setattr(phrases, "GATHERED", 20)
    text = " ".join(["one two three four"] * 400)
    long = [*rows, ("en", text), ("en", "w" * 500 + " end " + "v" * 200)]
    found = phrases.mine(frame(spark, long), top=1000, least=4, budget=100)
    assert sorted(tuple(r) for r in found.collect()) == brute(long, 1000, 3, 4)


def test_empty(spark):
    assert phrases.mine(frame(spark, [])).count() == 0
    assert phrases.mine(frame(spark, [("en", None), (None, "...")])).count() == 0


def test_scores_beyond_64_bits(spark):
    words = spark.createDataFrame([("en", "a", 4 * 10**12), ("en", "b", 3 * 10**12 + 1)], "lang string, phrase string, n long")
    pair = spark.createDataFrame([("en", "a b", 2_999_999_999_999)], "lang string, phrase string, n long")
    row = phrases.score_cuts(words, pair).first()
    assert row.score == 10**6 * 2_999_999_999_999**2 // (4 * 10**12 * (3 * 10**12 + 1))
