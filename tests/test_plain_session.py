"""Keyed streams in a session with Spark's own settings, as others build it, whose workers do not have the package."""

import os
import subprocess
import sys
import textwrap

import pytest


@pytest.mark.parametrize("name", ["stream_fraud_alerts_tight", "stream_saga_replay", "stream_step_timeouts", "stream_idempotency", "stream_alarm_high_fraud"])
def test_keyed_stream(tmp_path, data, name):
    here = os.path.dirname(os.path.abspath(__file__))
    code = f"""
        import sys
        sys.path[:0] = [{os.path.dirname(here)!r}, {here!r}]
        from pyspark.sql import SparkSession
        build = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
        spark = build.config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate()
        import duckdb
        import test_oracles
        duck = duckdb.connect()
        for table in test_oracles.TABLES.split():
            duck.sql(f"CREATE VIEW {{table}} AS SELECT * FROM '{data}/{{table}}.parquet'")
        test_oracles.test_query(spark, duck, {data!r}, {name!r})
        print("SAME", spark.conf.get("spark.sql.streaming.stateStore.providerClass", None))
    """
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "SAME None" in done.stdout, done.stderr[-2000:]
