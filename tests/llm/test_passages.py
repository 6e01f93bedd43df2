import random
import time

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwarden.llm import passages


@settings(max_examples=150)
@given(st.lists(st.integers(0, 30), max_size=60), st.integers(1, 9))
def test_each_run_lies_in_the_one_window_of_its_minimum(values, run):
    array = (np.array(values, dtype=np.uint64) + np.uint64(1)) << np.uint64(40)
    windows = passages.compact_windows(array, run)
    assert len({c for _, c, _ in windows}) == len(windows)
    for i in range(len(values)):
        for j in range(i + run - 1, len(values)):
            least = min(range(i, j + 1), key=lambda k: (values[k], k))
            assert [c for a, c, b in windows if a <= i <= c <= j <= b] == [least]
    for a, c, b in windows:
        assert b - a + 1 >= run and a <= c <= b


@pytest.mark.parametrize("few", [-1, passages.FEW_BYTES])
def test_repeats_are_found_with_their_places(documents, words, monkeypatch, few):
    monkeypatch.setattr(passages, "FEW_BYTES", few)
    rows = [(i, words(i, 200)) for i in range(6)]
    rows[3] = (3, words(30, 80) + "\n" + words(1, 60, 70) + " " + words(31, 90))
    rows[5] = (5, words(1, 51, 20))
    found = {tuple(r) for r in passages.find(documents(rows)).collect()}
    assert found == {(3, 80, 60, 1, 70, 60), (5, 0, 51, 1, 20, 51)}


def test_shorter_repeats_and_repeats_within_a_text_are_none(documents, words):
    rows = [(0, words(0, 300)), (1, words(1, 100) + " " + words(0, 45, 100) + " " + words(2, 100)), (2, (words(3, 80) + " ") * 3)]
    assert passages.find(documents(rows)).count() == 0


@pytest.mark.parametrize("edits", [2, 4])
def test_near_passages(documents, words, edits):
    rng = random.Random(edits)
    w = words(0, 200, 50).split()
    for k in range(edits):
        w[20 + k * 40] = f"edit{rng.random()}"
    rows = [(0, words(0, 300)), (1, words(1, 100) + " " + " ".join(w) + " " + words(2, 100))]
    found = passages.find(documents(rows)).collect()
    assert [(r.doc_id, r.other_doc_id) for r in found] == [(1, 0)]
    assert found[0].first_word == 100 and found[0].n_words == 200


def test_a_passage_that_most_documents_share(documents, words):
    rows = [(i, words(i, 60) + " " + words(999, 70) + " " + words(i, 60, 60)) for i in range(150)]
    found = passages.find(documents(rows)).collect()
    # a group's first document may differ between windows, so a passage can be told of two earlier ones
    assert {(r.doc_id, r.first_word, r.n_words) for r in found} == {(i, 60, 70) for i in range(1, 150)}
    assert {r.doc_id for r in found if r.other_doc_id == 0} == set(range(1, 150)) and len(found) < 2 * 150


def covered(found):
    return {(r[0], w) for r in found for w in range(r[1], r[1] + r[2])}


def brute(rows):
    """Words of passages from all pairs of documents, by the operator's own comparison of whole texts."""
    hashes, begins = passages.ordered_shingles(pa.array([t for _, t in rows]))
    texts = [hashes[a:b] for a, b in zip(begins[:-1], begins[1:], strict=True)]
    pairs = ((i, j) for j in range(len(rows)) for i in range(j))
    return covered((rows[j][0], low, high - low + 4) for i, j in pairs for low, high in passages.agreeing(texts[j], texts[i]))


@pytest.mark.parametrize("common", [64, 10_000])
def test_passages_around_a_line_that_earlier_documents_have_alone(documents, words, monkeypatch, common):
    monkeypatch.setattr(passages, "COMMON", common, raising=False)
    line = words(900, 35)
    rows = [(i, words(i, 40) + " " + (line if i % 3 else words(900, 30)) + " " + words(i, 50, 40)) for i in range(50)]
    for i in range(50, 90):
        k = 100 + (i - 50) % 20
        rows.append((i, words(i, 60) + " " + words(k, 12) + " " + line + " " + words(k, 13, 12) + " " + words(i, 60, 60)))
    want = brute(rows)
    assert {d for d, _ in want} == set(range(70, 90))
    assert covered(passages.find(documents(rows)).collect()) == want


def test_a_line_that_also_stands_outside_of_the_passage(documents, words):
    rows = []
    for k in range(30):
        line = words(500 + k, 30)
        passage = words(600 + k, 15) + " " + line + " " + words(700 + k, 15)
        rows.append((k, words(k, 10) + " " + line + " " + words(k, 460, 10) + " " + passage + " " + words(k, 50, 470)))
        rows.append((100 + k, words(100 + k, 5) + " " + line + " " + words(100 + k, 475, 5) + " " + passage))
    want = brute(rows)
    assert {d for d, _ in want} == set(range(100, 130))
    assert covered(passages.find(documents(rows)).collect()) == want


def test_all_near_passages_at_the_least_share(documents, words):
    rows = []
    for k in range(500):
        w = words(20_000 + k, 60).split()
        rows.append((k, words(k, 60) + " " + " ".join(w) + " " + words(k, 60, 60)))
        w[20], w[40] = "e20", "e40"
        rows.append((10_000 + k, words(10_000 + k, 60) + " " + " ".join(w) + " " + words(10_000 + k, 60, 60)))
    found = {(r.doc_id, r.first_word, r.n_words, r.other_doc_id) for r in passages.find(documents(rows)).collect()}
    assert found == {(10_000 + k, 60, 60, k) for k in range(500)}


def test_texts_that_repeat_one_word(documents):
    found = passages.find(documents([(1, "word " * 3000), (2, "word " * 2000)])).collect()
    assert covered(found) == {(2, w) for w in range(2000)}


def test_cut_takes_the_passages_out(documents, words):
    rows = [(0, words(0, 100)), (1, "Before " + words(0, 100) + " after é."), (2, words(0, 100)), (3, None), (4, ""), (None, words(0, 100))]
    docs = documents(rows)
    left = passages.cut(docs, passages.find(docs))
    assert left.columns == docs.columns
    found = {r.doc_id: r for r in left.collect()}
    assert set(found) == {0, 1, 3, 4, None}
    assert found[1].text == "Before after é." and found[1].n_chars == 15 and found[1].lang == "en"
    assert found[0].text == rows[0][1] and found[3].text is None


def test_empty(documents):
    docs = documents([])
    assert passages.find(docs).count() == 0
    assert passages.cut(docs, passages.find(docs)).count() == 0


def test_rows_of_one_id_with_other_texts_are_left_whole(documents, words):
    """A passage of one row must not be cut out of another row's text."""
    line, own, other = words(1, 60), words(2, 40), words(3, 90)
    docs = documents([(1, line), (2, f"{own} {line}"), (2, other), (3, f"{line} {own}"), (3, f"{line} {own}")])
    kept = sorted((r.doc_id, r.text) for r in passages.cut(docs, passages.find(docs)).collect())
    assert [t for d, t in kept if d < 3] == [line, *sorted([f"{own} {line}", other])]
    assert len([t for d, t in kept if d == 3]) in (0, 2) and all(line not in t for d, t in kept if d == 3)


def test_pairs_of_a_shared_line_grow_with_its_documents(documents, words, monkeypatch):
    """Documents that share one line and nothing else must not meet each other."""
    pairs = []
    plain = passages.candidates

    def counted(*args):
        out = passages.materialize(plain(*args), "counted")
        pairs[-1] += out.count()
        return out

    monkeypatch.setattr(passages, "candidates", counted)
    for m in (150, 600):
        pairs.append(0)
        line = words(5000, 30)
        rows = [(i, words(i, 50) + " " + line + " " + words(i, 50, 50)) for i in range(m)]
        assert passages.find(documents(rows)).count() == 0
    assert 0 < pairs[1] <= 4.5 * pairs[0] and pairs[1] <= 30 * 600


def lines_and_passages(words):
    """Texts of lines that many documents have, among them passages of 50 words and more, exact and near."""
    rng = random.Random(7)
    pool = [words(3000 + k, rng.randint(12, 44)) for k in range(6)]
    shared = [words(4000 + k, 15) + " " + rng.choice(pool) + " " + words(4100 + k, rng.randint(20, 40)) for k in range(40)]
    rows = []
    for i in range(400):
        parts = [words(i, 30), rng.choice(pool), words(i, 20, 30), rng.choice(pool), words(i, 25, 50)]
        if i % 4 == 0:
            passage = shared[rng.randrange(40)].split()
            if i % 8 == 0:
                passage[rng.randrange(5, len(passage) - 5)] = f"edit{i}"
            parts.insert(rng.choice((1, 3)), " ".join(passage))
        rows.append((i, " ".join(parts)))
    return rows


def repeated_words(rows):
    """(document, place) of words in runs of 50 that an earlier document has too, by a plain loop over the texts."""
    seen, out = {}, set()
    for doc, text in rows:
        w = text.split()
        for i in range(len(w) - 49):
            if seen.setdefault(tuple(w[i : i + 50]), doc) != doc:
                out.update((doc, k) for k in range(i, i + 50))
    return out


def test_recall_among_common_lines_and_the_same_result_for_any_partitions(documents, words):
    rows = lines_and_passages(words)
    results = [{tuple(r) for r in passages.find(documents(rows).repartition(n)).collect()} for n in (1, 7, 64)]
    assert results[0] == results[1] == results[2]
    found = covered(results[0])
    exact, near = repeated_words(rows), brute(rows)
    assert len(exact) > 2000 and exact <= found
    assert len(near & found) >= 0.99 * len(near)
    by_doc = {d for d, _ in near}
    assert {d for d, _ in found} <= by_doc


def stretches(count, alike):
    """Rows of two stretches: unrelated ones, or also copies, edited and moved ones, repeats and empty ones."""
    rng = np.random.default_rng(count)
    rows = []
    for i in range(count):
        here, there = (rng.integers(0, 1 << 32, rng.integers(1, 250), dtype=np.uint32) for _ in range(2))
        kind = i % 6 if alike else 0
        if kind == 1:
            there = np.concatenate((there[:9], here, there[9:20]))
        elif kind == 2:
            there = here + (rng.random(len(here)) < rng.random() * 0.3).astype(np.uint32)
        elif kind == 3:
            there = np.concatenate((here[len(here) // 2 :], there[:30], here[: len(here) // 2]))
        elif kind == 4:
            here, there = here % 40, there % 40
        elif kind == 5:
            there = there[:0]
        rows.append({"doc": i, "low": 46 * (i % 5), "here": here.tobytes(), "o_doc": i + 1, "o_low": 46 * (i % 3), "there": there.tobytes()})
    kinds = [("doc", pa.int64()), ("low", pa.int32()), ("here", pa.binary()), ("o_doc", pa.int64()), ("o_low", pa.int32()), ("there", pa.binary())]
    return pa.RecordBatch.from_pylist(rows, pa.schema(kinds))


def each_alone(batch):
    """The passages of rows that are compared one by one."""
    out = []
    for r in batch.to_pylist():
        here, there = (np.frombuffer(r[c], np.uint32) for c in ("here", "there"))
        for low, high in passages.agreeing(here, there):
            at = np.flatnonzero(np.isin(there, here[low:high]))
            out.append((r["doc"], r["low"] + low, high - low + 4, r["o_doc"], r["o_low"] + int(at[0]), int(at[-1] - at[0]) + 5))
    return out


def together(batch):
    return [tuple(r.values()) for part in passages._check(iter([batch])) for r in part.to_pylist()]


@pytest.mark.parametrize("slices", [1, 1 << 12, 1 << 18])
def test_stretches_compared_together_are_those_compared_one_by_one(monkeypatch, slices):
    monkeypatch.setattr(passages, "SLICES", slices)
    for batch in (stretches(600, True), stretches(600, True).slice(101, 300), stretches(5, False), stretches(0, True)):
        assert together(batch) == each_alone(batch)
    assert len(each_alone(stretches(600, True))) > 100


def test_comparing_many_stretches_costs_far_less_than_a_call_for_each():
    batch = stretches(3000, False)
    seconds = []
    for compare in (each_alone, together) * 3:
        start = time.process_time()
        assert compare(batch) == []
        seconds.append(time.process_time() - start)
    assert min(seconds[1::2]) < min(seconds[::2]) / 2


def test_the_first_of_equal_windows_near_each_other_stands_for_all():
    rng = random.Random(3)
    sizes = [900, 0, 400, 60]
    block = passages.Block(np.arange(sum(sizes), dtype=np.uint64), np.concatenate(([0], np.cumsum(sizes))))
    at = np.array(sorted(rng.sample(range(sum(sizes)), 500)))
    values = np.array([rng.choice([7, 8, 9, 1 << 63, rng.randrange(1 << 64)]) for _ in at], np.uint64)
    left, right = (np.array([x + s * rng.randrange(40) for x in at]) for s in (-1, 1))
    want = {}
    for v, low, x, high in zip(values.tolist(), left.tolist(), at.tolist(), right.tolist(), strict=True):
        first = want.setdefault((block.text[x], v, block.place[x] // passages.RUN), [x, low, high, 0])
        if first[0] != x:
            first[2:] = max(first[2], high), 1
    rows = {(t, v, block.place[x], x - low, high - x, thin, 5) for (t, v, _), (x, low, high, thin) in want.items()}
    value, text, pack = passages.packed(block, values, left, at, right, 5)
    found = zip(text.tolist(), value.view(np.uint64).tolist(), (pack >> 22).tolist(), (pack >> 14 & 255).tolist(), (pack >> 6 & 255).tolist(), (pack >> 4 & 1).tolist(), (pack & 15).tolist(), strict=True)
    assert len(value) == len(rows) < len(at) and set(found) == rows


def test_lesser_keys_beyond_a_long_row_of_greater_ones():
    keys = np.concatenate([np.arange(3000, 6000), np.random.default_rng(5).permutation(3000), np.arange(2000)]).astype(np.uint64)
    begins = np.zeros(len(keys), bool)
    begins[[0, 3100, 3101, 5000]] = True
    want = []
    for i, key in enumerate(keys.tolist()):
        last = max(np.flatnonzero(begins[: i + 1]))
        want.append(next((j for j in range(i - 1, last - 1, -1) if keys[j] <= key), -1))
    assert passages._lesser_before(keys, begins).tolist() == want
