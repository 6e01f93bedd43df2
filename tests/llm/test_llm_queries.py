"""Each query against its SQL where it has one, and the pipeline against its stages done plainly."""

import hashlib

import duckdb
import public_tokenizers
import pytest
from test_decontam import brute as leaks
from test_sketch_join import brute as groups

import corpus_pipeline
from tillwarden.llm import bpe, passages, queries, toxicity


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, data, name):
    found = queries.QUERIES[name](spark, data)
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    result = con.execute(queries.ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(found.columns)
    assert sorted(map(repr, (tuple(r[n] for n in names) for r in found.collect()))) == sorted(map(repr, result.fetchall()))


def test_sketch_join_query(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    assert {tuple(r) for r in queries.op4_sketch_join(spark, data).collect()} == groups(rows)


def test_pipeline(spark, data):
    """The stages' results from plain loops over the documents; only the learned lexicon and the passages are shared."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    lexicon = queries.toxic_lexicon(spark, data)
    bad = {r.doc_id for r in toxicity.score(docs, lexicon).filter("score >= 0.5").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in bad]
    kept = {d for d, _, c in groups(rows) if d == c}
    rows = [r for r in rows if r[0] in kept]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    rows = [(r.doc_id, r.text) for r in passages.cut(frame, passages.find(frame)).collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    held = {d for d, _, _ in leaks(rows, items)}
    code = bpe.coder(bpe.read_ranks(public_tokenizers.path(queries.VOCABULARY)), public_tokenizers.PATTERN)
    want = set()
    for doc, text in rows:
        if doc not in held:
            ids = code.encode_ordinary(text)
            want.add((doc, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert {tuple(r) for r in corpus_pipeline.run(spark, data).collect()} == want
    assert 0 < len(bad) and len(held) and len(want) < docs.count()


def test_stages_take_odd_rows(spark, data, documents):
    docs = documents([(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "x y"), (9, "word " * 50_000)])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, data)
        assert out.count() == docs.count(), name
        assert stage(spark, docs.limit(0), data).count() == 0
        docs = out
