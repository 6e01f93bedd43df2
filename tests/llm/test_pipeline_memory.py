"""The pipeline's stages get texts in batches bounded by bytes, and all of them."""

import pyarrow as pa

import corpus_pipeline


def test_stages_get_small_batches(spark, documents, tmp_path, monkeypatch):
    def probe(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"many": pa.array([b.num_rows]), "size": pa.array([b.nbytes])})

    def stage(spark, docs, sf_dir):
        return docs.select("doc_id", "text").mapInArrow(probe, "many long, size long")

    documents([(i, f"{i:04d}" * 1000) for i in range(3000)]).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("probe", stage)])
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sum(r.many for r in found) == 3000
    assert max(r.size for r in found) < 3 << 20
    assert spark.conf.get(key) == before


def test_a_stage_alone_gets_small_batches(spark, documents, tmp_path, monkeypatch):
    def probe(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"many": pa.array([b.num_rows]), "size": pa.array([b.nbytes])})

    def sizes(docs, *_):
        return docs.select("doc_id", "text").mapInArrow(probe, "many long, size long")

    documents([(i, f"{i:04d}" * 1000) for i in range(3000)]).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline.queries, "toxic_lexicon", lambda *_: None)
    monkeypatch.setattr(corpus_pipeline.toxicity, "reject", sizes)
    monkeypatch.setattr(corpus_pipeline.sketch_join, "keep_first", sizes)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    for _, stage in corpus_pipeline.STAGES[:2]:
        spark.conf.unset(key)
        try:
            found = stage(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)).collect()
        finally:
            spark.conf.set(key, before)
        assert sum(r.many for r in found) == 3000
        assert max(r.size for r in found) < 3 << 20
