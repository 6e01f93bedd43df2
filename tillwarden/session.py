"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_STORE = "spark.sql.streaming.stateStore"
_PROVIDERS = "org.apache.spark.sql.execution.streaming.state"
#: Settings of keyed state on streams. Each partition's store has its own write buffers, so their sum is bounded.
STATE = {
    f"{_STORE}.providerClass": f"{_PROVIDERS}.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
}

#: Bytes of rows that go to a Python worker at once, for keyed state on streams.
SENT = ("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def build_session(app: str = "tillwarden", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # A skewed join may be split even when an operator above relies on its partitioning.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config(map=STATE)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Event times are UTC throughout; the setting is per session and safe to repeat."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state in RocksDB, as ``transformWithState`` needs it; Spark's default has no maps or timers.

    A query takes its session's settings when it starts; afterwards the session has its own again. A provider that it
    was given other than Spark's default stays. Rows go to Python in batches of bounded size, as they may be whole blocks.
    """
    given = spark.conf.get(f"{_STORE}.providerClass", None)
    wanted = dict([SENT])
    if given in (None, f"{_PROVIDERS}.HDFSBackedStateStoreProvider"):
        wanted |= STATE
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, visible to every executor.

    Without that setting only a local session gets a folder, a machine-local one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tillwarden-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: reused results survive lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scale(spark: SparkSession, name: str, default: int) -> int:
    """Tuning number from the session (``tillwarden.<name>``), else the default."""
    return int(spark.conf.get(f"tillwarden.{name}", os.environ.get(f"TILLWARDEN_{name.upper()}", str(default))))
