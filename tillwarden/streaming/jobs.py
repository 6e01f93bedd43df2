"""Structured Streaming jobs. Each reuses the batch operators and can run live or ``availableNow``.

Sinks of ``foreachBatch`` overwrite a folder named by the batch id, so a replayed batch leaves the same
rows. Every job has its own checkpoint folder; do not share or reorder them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import MONEY
from ..operators import fraud, landing, ledger, lifecycle, monitoring, parsing
from ..session import keyed_state
from ..sources.schemas import ACCOUNT_BALANCE, FraudRule
from ..sources.topics import TOPICS, write_kafka
from .late import LateCounter

WATERMARK = "5 seconds"
CHECKPOINT_INTERVAL = "60 seconds"
DAY_MS = 86_400_000
_DELAY_MS = 1000 * int(WATERMARK.split()[0])
_MARKS = "started_ms long, replied_ms long, now_ms long"

HISTORY = "account_id string, occurred_ms long, seq long, amount double, day long, batch_id long"


@dataclass(frozen=True)
class Trigger:
    """``available_now`` drains the source and stops; else a batch starts every ``interval``."""

    available_now: bool = True
    interval: str = CHECKPOINT_INTERVAL

    def options(self) -> dict:
        return {"availableNow": True} if self.available_now else {"processingTime": self.interval}


def _start(writer, checkpoint: str, trigger: Trigger) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger.options()).start()


def _start_keyed(df: DataFrame, mode: str, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: Trigger) -> StreamingQuery:
    """A query with ``transformWithState``, in a session of any settings."""
    with keyed_state(df.sparkSession):
        return _start(df.writeStream.outputMode(mode).foreachBatch(write), checkpoint, trigger)


def batch_folder(root: str, name: str, batch_id: int) -> str:
    return f"{root}/{name}/batch_id={batch_id}"


def read_batches(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}").drop("batch_id")


def hourly_metrics(
    payments: DataFrame,
    root: str,
    trigger: Trigger = Trigger(),
    publish: Callable[[str, DataFrame], None] | None = None,
    late: LateCounter | None = None,
) -> StreamingQuery:
    """Hourly metrics, written once when the watermark passes an hour, as a table and as keyed records.

    Only this branch drops late rows; ``late`` counts them.
    """
    if late is not None:
        payments = late.observed(payments, "occurred_at", 3_600_000)
    metrics = monitoring.hourly_metrics(payments.withWatermark("occurred_at", WATERMARK))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            batch.write.mode("overwrite").parquet(batch_folder(root, "hourly_metrics", batch_id))
            records = landing.metric_records(batch)
            records.write.mode("overwrite").parquet(batch_folder(root, "metric_records", batch_id))
            if publish is not None:
                publish(TOPICS["metrics"], records)
        finally:
            batch.unpersist()

    writer = metrics.writeStream.outputMode("append").foreachBatch(write)
    return _start(writer, f"{root}/_checkpoints/hourly_metrics", trigger)


def land(records: DataFrame, root: str, table: str = "payment_events", trigger: Trigger = Trigger()) -> StreamingQuery:
    """Rows of a topic by month in ``table``; records that cannot be landed in ``<table>_dlq``.

    The two add up to what was read.
    """
    read_topic, dated = landing.TOPIC_READERS[table]

    def write(batch: DataFrame, batch_id: int) -> None:
        read = read_topic(batch).persist()
        try:
            good = landing.landed(read).withColumn("month", F.date_format(dated, "yyyyMM"))
            good.write.mode("overwrite").partitionBy("month").parquet(batch_folder(root, table, batch_id))
            landing.topic_dlq(read).write.mode("overwrite").parquet(batch_folder(root, f"{table}_dlq", batch_id))
        finally:
            read.unpersist()

    return _start(records.writeStream.foreachBatch(write), f"{root}/_checkpoints/{table}", trigger)


def saga_outcomes(events: DataFrame, root: str, trigger: Trigger = Trigger()) -> StreamingQuery:
    """Running counter of outcomes; each batch writes the complete (three-row) result to its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(batch_folder(root, "saga_outcomes", batch_id))

    writer = lifecycle.saga_outcomes(events).writeStream.outputMode("complete").foreachBatch(write)
    return _start(writer, f"{root}/_checkpoints/saga_outcomes", trigger)


def timed_out_steps(
    started: DataFrame, replied: DataFrame, root: str, timeout_seconds: int = lifecycle.TIMEOUT_SECONDS, trigger: Trigger = Trigger()
) -> StreamingQuery:
    """Failure replies for steps without a reply in time.

    ``started`` and ``replied`` have ``saga_id, step_name`` and ``started_at`` or ``replied_at``. Each batch joins its steps
    and those still open with the replies, by a join that sorts on disk. Time is the lesser of both sides' last times less
    the watermark's delay; what had no reply when it passes is told, and rows behind it are late and dropped. Kept for the
    next batch are the open steps and newer replies, one timeout's worth, in two folders written in turn.
    """
    timeout_ms = timeout_seconds * 1000
    sides = ((started, "started_at", True), (replied, "replied_at", False))
    left, right = (df.select("saga_id", "step_name", F.col(at).alias("at"), F.lit(is_start).alias("is_start")) for df, at, is_start in sides)

    def state(batch_id: int) -> str:
        return f"{root}/_state/timed_out_steps/{batch_id % 2}"

    def unmet(steps: DataFrame, replies: DataFrame) -> DataFrame:
        s, r = steps.alias("s"), replies.alias("r")
        in_time = F.col("r.at").between(F.col("s.at"), F.col("s.at") + F.expr(f"INTERVAL {timeout_seconds} SECONDS"))
        return s.join(r, (F.col("s.saga_id") == F.col("r.saga_id")) & (F.col("s.step_name") == F.col("r.step_name")) & in_time, "left_anti")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marks, passed, earlier = [0, 0], 0, None
        if batch_id > 0:
            *marks, passed = spark.read.schema(_MARKS).parquet(f"{state(batch_id - 1)}/marks").first()
            earlier = spark.read.schema(batch.schema).parquet(f"{state(batch_id - 1)}/kept")
        last = batch.agg(*[F.max(F.when(F.col("is_start") == side, F.unix_millis("at"))) for side in (True, False)]).first()
        marks = [mark if ms is None else max(mark, ms - _DELAY_MS) for mark, ms in zip(marks, last)]
        now = max(passed, min(marks))
        rows = batch.filter(F.col("at") > F.timestamp_millis(F.lit(passed)))
        rows = rows if earlier is None else rows.unionByName(earlier)
        steps, replies = rows.filter("is_start"), rows.filter("NOT is_start")
        due = F.timestamp_millis(F.lit(now - timeout_ms - 1))
        late = unmet(steps.filter(F.col("at") <= due), replies).select(
            "saga_id",
            "step_name",
            F.lit("FAILURE").alias("status"),
            F.lit(f"Step timed out after {timeout_seconds}s").alias("error_message"),
            F.lit(False).alias("is_compensation"),
        )
        late.write.mode("overwrite").parquet(batch_folder(root, "timed_out_steps", batch_id))
        still = unmet(steps.filter(F.col("at") > due), replies.filter(F.col("at") > due))
        newer = replies.filter(F.col("at") > F.timestamp_millis(F.lit(now)))
        still.unionByName(newer).write.mode("overwrite").parquet(f"{state(batch_id)}/kept")
        spark.createDataFrame([(*marks, now)], _MARKS).coalesce(1).write.mode("overwrite").parquet(f"{state(batch_id)}/marks")

    events = left.unionByName(right).filter(F.col("at").isNotNull())
    return _start(events.writeStream.foreachBatch(write), f"{root}/_checkpoints/timed_out_steps", trigger)


def detect(
    records: DataFrame,
    root: str,
    rules: Callable[[], FraudRule],
    profiles: Callable[[], DataFrame],
    trigger: Trigger = Trigger(),
    publish: Callable[[str, DataFrame], None] | None = None,
) -> StreamingQuery:
    """Scores raw payments as they arrive: alerts, user scores and dead letters.

    Results are written as tables; ``publish`` also gets them as keyed JSON records by topic name.

    ``rules`` and ``profiles`` are called for each batch, so a change acts on the next one. The look-back
    history is a narrow table by day and batch. A batch reads back only the days that its own windows reach and
    the accounts and profiles it touches, and is scored by the same sweep as the batch job, hot accounts included. Payments are never
    dropped for being late.
    """

    def score(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        parsed = parsing.parse_payments(batch).persist()
        try:
            letters = parsing.dead_letters(parsed)
            letters.write.mode("overwrite").parquet(batch_folder(root, "dead_letters", batch_id))

            rule = rules()
            reach = max(rule.velocity_window_ms, rule.structuring_window_hours * fraud.HOUR_MS)
            fresh = parsing.valid_payments(parsed).withColumn("seq", F.col("offset"))
            day = F.floor(F.col("occurred_ms") / DAY_MS)
            kept = fresh.select("account_id", "occurred_ms", "seq", "amount", day.alias("day"))
            kept.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy("day", "batch_id").parquet(f"{root}/history")

            new_rows = fresh.drop("topic", "partition", "offset", "key", "ingest_ts").withColumn("is_new", F.lit(True))
            touched = fresh.select("account_id").distinct()
            seen = new_rows
            if batch_id > 0:
                # The days that some window of this batch reaches: a record of long ago adds its own few.
                reached = F.sequence(F.floor((F.col("occurred_ms") - reach) / DAY_MS), day)
                days = [r[0] for r in fresh.select(F.explode(reached)).distinct().collect()]
                history = (
                    spark.read.schema(HISTORY)
                    .parquet(f"{root}/history")
                    .filter(F.col("day").isin(days) & (F.col("batch_id") < batch_id))
                    .drop("day", "batch_id")
                )
                earlier = history.join(touched, "account_id", "left_semi").withColumn("is_new", F.lit(False))
                seen = new_rows.unionByName(earlier, allowMissingColumns=True)
            known = profiles().join(touched.withColumnRenamed("account_id", "user_id"), "user_id", "left_semi")
            scored = fraud.detect(seen, rule, known, keep=F.col("is_new")).persist()
            try:
                alerts = fraud.fraud_alerts(scored)
                alerts.write.mode("overwrite").parquet(batch_folder(root, "alerts", batch_id))
                scores = fraud.user_scores(scored)
                scores.write.mode("overwrite").parquet(batch_folder(root, "scores", batch_id))
                if publish is not None:
                    publish(TOPICS["alerts"], landing.alert_records(alerts))
                    publish(TOPICS["scores"], landing.score_records(scores))
                    publish(TOPICS["dead_letter"], landing.dead_letter_records(letters))
            finally:
                scored.unpersist()
        finally:
            parsed.unpersist()

    writer = records.writeStream.foreachBatch(score)
    return _start(writer, f"{root}/_checkpoints/detect", trigger)


def to_kafka(servers: str) -> Callable[[str, DataFrame], None]:
    """Publisher for ``detect``. It is at-least-once: a replayed batch sends its records again."""
    return lambda topic, records: write_kafka(records, servers, topic)


#: Batches whose changed balances are read back before they are merged into a new base.
MERGE_EVERY = 16


_CHANGES = T.StructType([*ACCOUNT_BALANCE.fields, T.StructField("batch_id", T.LongType())])


def _project(root: str) -> Callable[[DataFrame, int], None]:
    """Balance events of a batch, and the balances it changed; every ``MERGE_EVERY`` batches a merged base."""

    def project(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.withColumn("amount", F.col("amount").cast(MONEY)).persist()
        try:
            touched = batch.select("account_id", "currency").distinct()
            opening = current_balances(spark, root, before=batch_id)
            known = opening.join(touched, ["account_id", "currency"], "left_semi")
            events = ledger.balance_events(batch, known)
            events.write.mode("overwrite").parquet(batch_folder(root, "balance_events", batch_id))
            changed = ledger.merge_balances(known, ledger.account_balance(batch))
            changed.write.mode("overwrite").parquet(batch_folder(root, "balance_changes", batch_id))
            if batch_id % MERGE_EVERY == MERGE_EVERY - 1:
                merged = current_balances(spark, root, before=batch_id + 1, based_before=batch_id)
                merged.write.mode("overwrite").parquet(batch_folder(root, "balance_base", batch_id))
        finally:
            batch.unpersist()

    return project


def current_balances(spark: SparkSession, root: str, before: int | None = None, based_before: int | None = None) -> DataFrame:
    """Balances after the batches below ``before`` (all of them if None): the last base and the changes since.

    Of an account's rows the newest holds; the base has one each, and at most ``MERGE_EVERY`` batches follow it.
    ``based_before`` asks for a base of an earlier batch than that.
    """
    if before is None:
        before = 1 + (spark.read.schema(_CHANGES).parquet(f"{root}/balance_changes").agg(F.max("batch_id")).first()[0] or 0)
    base = (before if based_before is None else based_before) // MERGE_EVERY * MERGE_EVERY - 1
    rows = spark.createDataFrame([], _CHANGES)
    if base >= 0:
        merged = spark.read.schema(ACCOUNT_BALANCE).parquet(batch_folder(root, "balance_base", base))
        rows = rows.unionByName(merged.withColumn("batch_id", F.lit(base).cast("long")))
    if before - 1 > base:
        changes = spark.read.schema(_CHANGES).parquet(f"{root}/balance_changes")
        rows = rows.unionByName(changes.filter((F.col("batch_id") > base) & (F.col("batch_id") < before)))
    newest = rows.groupBy("account_id", "currency").agg(F.max_by(F.struct(*ACCOUNT_BALANCE.names[2:]), "batch_id").alias("r"))
    return newest.select("account_id", "currency", "r.*")


def balances(payments: DataFrame, root: str, trigger: Trigger = Trigger()) -> StreamingQuery:
    """Balance events and changed balances from payments with an ``arrival`` number.

    Repeated event ids are dropped by keyed state (first delivery wins), also across batches. A batch writes the
    balances of the accounts it touches, no others.
    """
    writer = payments.dropDuplicates(["event_id"]).writeStream.foreachBatch(_project(root))
    return _start(writer, f"{root}/_checkpoints/balances", trigger)


def projection(records: DataFrame, root: str, trigger: Trigger = Trigger()) -> tuple[StreamingQuery, StreamingQuery]:
    """The ledger from the raw topic: poison records to ``<topic>.DLT`` and balances of the others.

    Both queries parse strictly and alike, so each record goes to one of them. The offset is the arrival.
    """
    strict = parsing.parse_payments_strict(records)

    def poison(batch: DataFrame, batch_id: int) -> None:
        parsing.projection_dlt(batch).write.mode("overwrite").parquet(batch_folder(root, "dlt", batch_id))

    letters = _start(strict.writeStream.foreachBatch(poison), f"{root}/_checkpoints/dlt", trigger)
    good = strict.filter(F.col("error").isNull()).withColumn("arrival", F.col("offset"))
    return letters, balances(good.drop("error", "value"), root, trigger)


def newest_batch(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rows of the last batch of a job whose batches hold complete results."""
    df = spark.read.parquet(f"{root}/{name}")
    last = df.agg(F.max("batch_id")).first()[0]
    return df.filter(F.col("batch_id") == last).drop("batch_id")
