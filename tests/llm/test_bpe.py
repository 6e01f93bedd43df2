import random

import public_tokenizers
import pytest

from tillwarden.llm import bpe

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def table():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def ranks(spark, table):
    return spark.sparkContext.broadcast(table)


def noise(rng, length):
    parts = ["word", " ", "  ", "\n", "\n\n", "'s", "'ll", "12", "é", "ünï", "漢字", "🙂", "!!", "\t", "\u00a0", "\u0085", "\x1c", "ab12", "...", "<|endoftext|>"]
    out = ""
    while len(out) < length:
        out += rng.choice(parts)
    return out[:length]


def test_ids_and_bytes_of_whole_texts(documents, table, ranks):
    rng = random.Random(3)
    texts = [None, "", " ", "hello world", "<|endoftext|>", "a" * 700, " " * 300, "x" * 63, "x" * 64, "x" * 65]
    texts += [noise(rng, n) for n in (30, 63, 64, 65, 130, 200, 777, 2000) for _ in range(12)]
    rows = list(enumerate(texts)) + [(3, "hello world"), (None, "no id")]
    coded = bpe.decode(bpe.encode(documents(rows), ranks, PATTERN, chunk=64, overlap=16), ranks).collect()
    code = bpe.coder(table, PATTERN)
    both = bpe.round_trip(documents(rows), ranks, PATTERN, chunk=64, overlap=16).collect()
    assert sorted(map(repr, both)) == sorted(map(repr, coded)) and len(coded) == len(rows)
    for r in coded:
        text = "no id" if r.doc_id is None else texts[r.doc_id] or ""
        assert list(r.ids) == code.encode_ordinary(text), repr(text)
        assert bytes(r.decoded) == text.encode()


def test_stitches_meet_after_a_cut_in_a_word():
    text = "some words go over the cut here and further on we are"
    left, right = bpe.boundaries(text[:40], PATTERN), bpe.boundaries(text[13:], PATTERN) + 13
    at = bpe.stitch(right[right < 35], left[left >= 13])
    assert at is not None and text[at] == " " and text[at - 1] != " "


def test_every_code_point_is_split_alike(table):
    import regex

    code, pattern = bpe.coder(table, PATTERN), regex.compile(PATTERN)
    for c in range(0, 0x110000, 7):
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}"
            assert [i for m in pattern.finditer(text) for i in code.encode_ordinary(m.group())] == code.encode_ordinary(text)


def test_no_rows(documents, ranks):
    assert bpe.decode(bpe.encode(documents([]), ranks, PATTERN), ranks).count() == 0
