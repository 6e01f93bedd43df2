"""Toxicity, quality and language: small cases, and held-out accuracy on the given tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwarden.llm import langid, quality, queries, toxicity
from tillwarden.sources.tables import read_table


@pytest.fixture(scope="module")
def tables(spark):
    folder = "/root/testdata/sf0.01"
    return read_table(spark, folder, "documents"), read_table(spark, folder, "labels")


LEXICON = toxicity.Lexicon({"moron": 2.0, "scum": 1.0}, {"lowei": 1.5}, ("moron sea", "loweita"), (-3.0, 3.0, 0.5))


@pytest.mark.parametrize(
    "text, weight",
    [
        ("", 0), ("moron", 2), ("Moron, SCUM!", 3), ("m0r0n", 2), ("m\u043er\u043en", 2), ("5cum", 1), ("oxymoron", 0), ("moronic", 0), ("loweix", 1.5), ("the moron sea is near", 0),
        ("moron seas", 2), ("moron sea moron", 2), ("loweita loweitas", 1.5), ("slowei", 0), ("8 100 8", 0), ("$cum", 0), ("m@ron s", 0),
    ],
)
def test_matches(text, weight):
    assert toxicity.weigh(toxicity.automaton(LEXICON), text) == weight


def test_score_and_reject_agree(documents):
    rows = [(1, None), (2, ""), (3, "moron"), (4, "fine words " * 5000), (5, "moron " + "fine " * 20_000), (5, "scum"), (None, "scum moron")]
    docs = documents(rows)
    scored = toxicity.score(docs, LEXICON).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored)
    left = toxicity.reject(docs, LEXICON)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in left.collect()) == sorted((r.doc_id or 0) for r in scored if r.score < 0.5)
    assert toxicity.score(documents([]), LEXICON).count() == 0 == toxicity.reject(documents([]), LEXICON).count()


def test_learning_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 1), (None, 0, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    docs = documents([(1, "a b c"), (2, None)])
    assert toxicity.learn(docs, none, F.lit(True)).constant == 0.0
    assert toxicity.learn(docs, one, F.lit(True)).constant == 1.0
    assert [r.score for r in quality.score(docs, quality.learn(docs, none, F.lit(True))).collect()] == [0.5, 0.5]
    assert all(r.score > 0.99 for r in quality.score(docs, quality.learn(docs, one, F.lit(True))).collect())


def accuracy(found, truth):
    rows = found.filter("held_out").join(truth, "doc_id").select("predicted", "truth").collect()
    return len(rows), np.mean([r.predicted == r.truth for r in rows])


def test_held_out_toxicity(spark, tables):
    found = queries.op3_toxicity(spark, "/root/testdata/sf0.01")
    assert found.count() == tables[0].count()
    rows, share = accuracy(found, tables[1].selectExpr("doc_id", "toxic AS truth"))
    assert rows > 50 and share >= 0.9


def test_held_out_quality(spark, tables):
    found = queries.op5_quality(spark, "/root/testdata/sf0.01")
    assert found.count() == tables[0].count()
    rows, share = accuracy(found, tables[1].selectExpr("doc_id", "quality AS truth"))
    assert rows > 50 and share >= 0.95


def test_held_out_language(spark, tables):
    found = queries.op9_language(spark, "/root/testdata/sf0.01").withColumnRenamed("lang_pred", "predicted")
    rows, share = accuracy(found, tables[0].selectExpr("doc_id", "lang AS truth"))
    assert rows > 200 and share >= 0.97


def test_language_of_odd_rows(spark, documents):
    train = spark.createDataFrame([(1, "the cat and the dog " * 9, "en"), (2, "der hund und die katze " * 9, "de"), (3, None, "en"), (4, "x", None), (None, "y", "de")], "doc_id long, text string, lang string")
    model = langid.learn(train, F.lit(True))
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "the dog"), (5, "die katze"), (6, "the dog " * 100_000), (7, "日本")]
    found = {r.doc_id: r for r in langid.identify(documents(rows), model).collect()}
    assert [found[i].lang_pred for i in range(1, 7)] == ["und", "und", "und", "en", "de", "en"]
    assert [found[i].score for i in (1, 2, 3)] == [0, 0, 0] and all(0 <= r.score <= 1 for r in found.values())
    assert found[7].lang_pred in ("en", "de")
    assert langid.learn(train.limit(0), F.lit(True)) is None
    assert [r.lang_pred for r in langid.identify(documents([(1, "a")]), None).collect()] == ["und"]
    assert langid.identify(documents([]), model).count() == 0


def plain_bits(text, counts, symbols, order=3):
    """Code length by the definition: escapes from longer to shorter contexts, with exclusion."""
    total = 0.0
    for i, s in enumerate(text):
        left = set(range(symbols))
        for n in range(order, -1, -1):
            here = {k: v for k, v in counts.get(tuple(text[i - n : i]), {}).items() if k in left}
            whole = sum(here.values()) + len(here) * (len(left) > len(here))
            if s in here:
                total -= np.log2(here[s] / whole)
                break
            if here:
                total -= np.log2(len(here) / whole)
            left -= set(here)
        else:
            total += np.log2(len(left))
    return total


def test_code_lengths_are_exact():
    import pyarrow as pa

    text = b"abracadabra abacus cabra " * 4
    runs = np.array([int.from_bytes(text[i : i + 4], "big") for i in range(len(text) - 3)])
    model = langid.build(np.array(["x"] * len(runs)), runs, np.ones(len(runs), np.int64), ["x"])
    size = round(len(model.places) ** (1 / 3))
    codes = model.symbols[np.frombuffer(text, np.uint8)].tolist()
    counts = {}
    for i in range(3, len(codes)):
        for n in range(4):
            counts.setdefault(tuple(codes[i - n : i]), {}).setdefault(codes[i], 0)
            counts[tuple(codes[i - n : i])][codes[i]] += 1
    for sample in ("abra", "zab", "cabaca brac", "scuba"):
        blanks = model.symbols[[32, 32, 32]].tolist()
        own = blanks + model.symbols[np.frombuffer(sample.encode(), np.uint8)].tolist()
        want = plain_bits(own, counts, size) - plain_bits(blanks, counts, size)
        # contexts of the three blanks before a text count as any others
        found = langid.code_lengths(model, pa.array([sample]))[0, 0]
        assert found == pytest.approx(want, rel=1e-4)
    shares = np.exp2(-model.lengths.reshape(-1, size).astype(float)).sum(axis=1)
    assert shares == pytest.approx(np.ones(len(shares)), abs=1e-3)
