import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def documents(spark):
    """Rows of documents from (doc_id, text), with columns whose names the operators use inside."""

    def make(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        return df.withColumns(
            {
                "lang": F.lit("en"),
                "source": F.lit("s"),
                "n_chars": F.length("text").cast("long"),
                "node": F.lit("x"),
                "key": F.lit("x"),
                "spans": F.lit("x"),
                "h": F.lit("x"),
                "score": F.lit("x"),
                "label": F.lit("x"),
                "row": F.lit("x"),
                "shard": F.lit("x"),
            }
        )

    return make


@pytest.fixture(scope="session")
def words():
    """Made-up running text: word number i of stream s."""

    def make(stream, count, start=0):
        return " ".join(f"w{stream}x{(i * 7919 + stream * 104729) % 1000003:x}" for i in range(start, start + count))

    return make
