import re

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from tillwarden.llm.texts import byte_spans, find_words, shingle_hashes, shingled, word_hashes

LETTERS = st.text(alphabet="abAB \t\n\x0b\x0c\ré☃\x00", max_size=40)


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0d]+", low)


def plain_shingles(text):
    w = plain_words(text)
    return [tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))] if w else []


@given(st.lists(st.one_of(st.none(), LETTERS), max_size=8))
def test_shingles_are_those_of_a_plain_split(texts):
    hashes, firsts = shingled(pa.array(texts, pa.string()))
    assert len(firsts) == len(texts) + 1
    name = {}
    for i, text in enumerate(texts):
        mine, theirs = hashes[firsts[i] : firsts[i + 1]].tolist(), plain_shingles(text)
        assert len(mine) == len(theirs)
        for h, s in zip(mine, theirs, strict=True):
            assert name.setdefault(s, h) == h
    assert len(set(name.values())) == len(name)


def test_slices_of_a_batch_and_words_beyond_a_block(monkeypatch):
    from tillwarden.llm import texts

    column = pa.array(["zz", "one two", None, "x" * 5000 + " y"], pa.string())
    whole = [h.tolist() for h in shingled(column.slice(1))]
    monkeypatch.setattr(texts, "BLOCK", 64)
    monkeypatch.setattr(texts, "_POWERS", [])
    assert [h.tolist() for h in shingled(column.slice(1))] == whole
    data, offsets = byte_spans(column.slice(1))
    starts, ends, firsts = find_words(data, offsets)
    assert firsts.tolist() == [0, 2, 2, 4]
    assert len(shingle_hashes(word_hashes(data, starts, ends), firsts)[0]) == 2


def test_words_are_hashed_alike_in_pieces_of_any_size(monkeypatch):
    from tillwarden.llm import texts

    column = pa.array(["one two THREE", "x" * 300 + " y " + "z " * 500, None, "one"], pa.string())
    whole = shingled(column)[0].tolist()
    for piece in (1, 7, 256):
        monkeypatch.setattr(texts, "PIECE", piece)
        monkeypatch.setattr(texts, "_POWERS", [])
        assert shingled(column)[0].tolist() == whole


def test_no_rows():
    hashes, firsts = shingled(pa.array([], pa.string()))
    assert len(hashes) == 0 and firsts.tolist() == [0]
    assert np.array_equal(shingled(pa.array([None, ""], pa.string()))[1], [0, 0, 0])
