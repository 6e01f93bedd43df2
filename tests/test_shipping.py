"""Task code must run on executors that do not have the package."""

import subprocess
import sys
import textwrap


def test_replay_runs_without_the_package_on_workers(tmp_path):
    import os

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
        import sys
        sys.path.insert(0, {repo!r})
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
        from tillwarden.operators import replay
        log = spark.createDataFrame(
            [("s", 0, "FRAUD_CHECK", "SUCCESS", None, False)],
            "saga_id string, seq long, step_name string, status string, error_message string, is_compensation boolean",
        )
        print("STATE", replay.saga_states(replay.replay(log, limit=10)).first().status)
    """
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(code)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180
    )
    assert "STATE EXECUTING" in done.stdout, done.stderr[-2000:]
