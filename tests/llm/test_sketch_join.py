import random

import pytest
from test_texts import plain_shingles

from tillwarden.llm import sketch_join
from tillwarden.llm.components import components


def brute(rows):
    sets = [set(plain_shingles(t)) for _, t in rows]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                label[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), doc), doc)
    return {(doc, len(sets[i]), least[top(i)]) for i, (doc, _) in enumerate(rows)}


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.random()}"
    return " ".join(w)


@pytest.mark.parametrize("size", [4, 9, 30, 150, 700, 3000])
def test_components_are_those_of_all_pairs(spark, documents, words, size):
    """Copies with growing numbers of edits: many pairs lie near the limit, most beyond it."""
    rng = random.Random(size)
    rows = []
    for stream in range(3):
        base = words(stream, size)
        rows += [(len(rows) + k, edited(rng, base, k * max(1, size // 150) // 2)) for k in range(12)]
        rows += [(len(rows) + k, base + " " + words(stream + 10, n)) for k, n in enumerate((1, size // 10, size // 6, size // 4 + 1))]
        rows.append((len(rows), base))
    rng.shuffle(rows)
    found = sketch_join.join(documents(rows)).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in found} == brute(rows)


def test_without_broadcast(documents, words, monkeypatch):
    monkeypatch.setattr(sketch_join, "FEW_IDS", -1)
    rows = [(i, words(i // 2, 60 + i % 2)) for i in range(20)]
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in sketch_join.join(documents(rows)).collect()} == brute(rows)


def test_a_line_that_all_share_links_nothing(documents, words):
    rows = [(i, words(99, 12) + "\n" + words(i, 20)) for i in range(120)]
    found = sketch_join.join(documents(rows)).collect()
    assert all(r.component_id == r.doc_id for r in found)


def test_nulls_copies_and_short_texts(documents):
    rows = [(5, None), (6, ""), (7, " \n "), (8, "a b"), (3, "A\tB"), (9, "a b"), (9, "a b"), (10, "x " * 3000), (11, "x " * 30), (None, "q r s")]
    found = {(r.doc_id, r.n_shingles, r.component_id) for r in sketch_join.join(documents(rows)).collect()}
    assert found == {(5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 1, 3), (3, 1, 3), (9, 1, 3), (10, 1, 10), (11, 1, 10), (None, 1, None)}
    assert sketch_join.join(documents(rows)).count() == len(rows)
    assert sketch_join.join(documents([])).count() == 0


def test_the_bound_holds_for_a_share_of_the_shingles():
    assert sketch_join.most_apart(100, 0) == (100 + 125) // 9
    band = int(sketch_join.band_of(2000))
    assert 2000 / 4 * 0.5 ** (band + 1) < sketch_join.most_apart(2000, band) < sketch_join.PIECES


def test_components_of_a_long_path(spark):
    edges = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    found = components(edges)
    assert found.count() == 301 and found.select("component").distinct().collect()[0][0] == 0


def test_rows_of_one_id_are_judged_by_their_own_text(documents, words):
    """Document 2 is a copy of 1 and the first of text B; none of the three texts may go."""
    a, b, c = (words(i, 40) for i in (1, 2, 3))
    docs = documents([(1, a), (2, a), (2, b), (3, b), (4, c), (4, c), (5, None), (5, a), (None, a)])
    kept = sorted((r.doc_id or 0, r.text or "") for r in sketch_join.keep_first(docs).collect())
    assert kept == sorted([(1, a), (2, b), (4, c), (4, c), (5, ""), (0, a)])
