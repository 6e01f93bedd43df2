import hashlib
from collections import Counter

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from tillwarden.llm import digest


@given(st.lists(st.text(max_size=30), min_size=1, max_size=6))
def test_counts_and_quartiles(texts):
    raw = [t.encode() for t in texts]
    counts = digest.bucket_counts(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64))
    assert counts.sum(axis=1).tolist() == [max(0, len(r) - 2) for r in raw]
    buckets = {}
    for r, row in zip(raw, counts, strict=True):
        one = digest.bucket_counts(np.frombuffer(r, np.uint8), np.array([0, len(r)]))[0]
        assert one.tolist() == row.tolist()
        codes = digest.digests(row[None], np.array([len(r)]))[0, 1:]
        ranked = sorted(row.tolist())
        assert codes.tolist() == [sum(c > ranked[k] for k in (63, 127, 191)) for c in row.tolist()]
        buckets[r] = codes
    assert digest.likeness(digest.fingerprint(raw), digest.fingerprint(raw)).tolist() == [1.0] * len(raw)


def test_parse_reverses_the_text_form():
    rows = digest.fingerprint([b"some text that is long enough", b""])
    assert [digest.parse(t).tolist() for t in digest.hex_digests(rows)] == rows.tolist()


def test_each_document_with_the_next(documents):
    texts = [None, "", "ab", "é" * 9, "the quick brown fox " * 40, "the quick brown fox " * 41, "x", "long " * 40_000, "last one here"]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    found = {r.doc_id: r for r in digest.compare_with_next(documents(rows[::-1]), partitions=4).collect()}
    plain = [t or "" for t in texts]
    for i, text in enumerate(plain):
        after, row, cut = plain[(i + 1) % len(plain)], found[i * 3], len(text) // 4
        want = (text[: len(text) - cut] + after[:cut]).encode()
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(want).hexdigest())
        own, other, following = (digest.fingerprint([t]) for t in (text.encode(), want, after.encode()))
        assert (row.fingerprint, row.edited_fingerprint) == (digest.hex_digests(own)[0], digest.hex_digests(other)[0])
        assert row.near_edited == digest.likeness(own, other)[0] and row.near_next == digest.likeness(own, following)[0]


def test_ties_one_row_and_none(documents):
    rows = [(1, "b"), (1, "a"), (1, "a"), (None, "n"), (2, "c")]
    found = digest.compare_with_next(documents(rows), partitions=3).collect()
    assert Counter(r.doc_id for r in found) == {1: 3, None: 1, 2: 1}
    assert [r.near_next for r in digest.compare_with_next(documents([(1, "only")])).collect()] == [1.0]
    assert digest.compare_with_next(documents([])).count() == 0
