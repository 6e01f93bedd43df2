"""Five stages that turn raw documents into token ids. Each works on what the stage before has kept.

A stage takes (spark, docs, sf_dir); its result is written as Parquet in the shared folder and read again as the next
one's docs. Rows without a doc_id and further columns pass through every stage but the last.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tillwarden.llm import decontam, passages, queries, sketch_join, toxicity
from tillwarden.session import materialize
from tillwarden.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the learned lexicon scores 0.5 or more."""
    return toxicity.reject(docs, queries.toxic_lexicon(spark, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: the smallest doc_id."""
    return sketch_join.keep_first(docs)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without passages that an earlier document has; a document that was nothing else goes."""
    return passages.cut(docs, materialize(passages.find(docs), "repeats"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold an item of the benchmark."""
    return decontam.clean(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and a digest of the ids and of the bytes that they decode to."""
    coded = queries.coded_documents(docs)
    return queries.code_digests(coded.select("doc_id", "ids", "decoded"))


#: Bytes of rows that go to a Python worker at once. Spark's own limits are 10,000 rows, 25 MB of the texts of sf0.1, and
#: 64 MB.
SENT = ("spark.sql.execution.arrow.maxBytesPerBatch", "2m")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """``stage`` with rows going to Python in batches of few bytes, whoever calls it.

    Its result is read after it has returned, by the limit that the session has then; so the session keeps this one.
    """

    @wraps(stage)
    def limited(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(*SENT)
        return stage(spark, docs, sf_dir)

    return limited


STAGES = [
    ("toxicity", in_small_batches(drop_toxic)),
    ("n-gram jaccard join", in_small_batches(drop_near_copies)),
    ("substring dedup", in_small_batches(cut_passages)),
    ("benchmark decontamination", in_small_batches(drop_leaks)),
    ("byte-level bpe", in_small_batches(encode)),
]

#: A learned lexicon, tree-built windows and merges by rank are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs within sends rows to Python in batches of few bytes; afterwards the session has its own limit again."""
    key, limit = SENT
    before = spark.conf.get(key)
    spark.conf.set(key, limit)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the table documents."""
    docs = read_table(spark, sf_dir, "documents")
    with small_batches(spark):
        for name, stage in STAGES:
            docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
