"""Lifecycle (saga) analytics over event and reply logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsonfields as J
from ..functions import quantiles
from ..functions.joins import first_per_key, salted_join
from ..functions.ordered import exact_percentile, running_totals
from ..sources.schemas import PAYMENT_STEPS

TIMEOUT_SECONDS = 30
_HOUR_MS = 3_600_000


def step_status(ok: Column, is_compensation: Column) -> Column:
    done = F.when(is_compensation, "COMPENSATED").otherwise("COMPLETED")
    return F.when(ok, done).otherwise("FAILED")


def step_event_type(status: Column) -> Column:
    return F.when(status.isin("COMPLETED", "COMPENSATED", "FAILED"), F.concat(F.lit("STEP_"), status)).otherwise("STEP_UPDATE")


def saga_event_type(status: Column) -> Column:
    return F.when(status.isin("COMPLETED", "COMPENSATED", "FAILED"), F.concat(F.lit("SAGA_"), status)).otherwise("SAGA_UPDATE")


def payload_payment_id(payload: Column) -> Column:
    """Field of a JSON payload as text; NULL for bad JSON, a missing field or JSON null."""
    return J.value(J.parse(payload, ["paymentId"]), "paymentId", "string")


def next_action(step: Column, ok: Column, is_compensation: Column, statuses: dict[str, Column], retries: dict[str, Column]) -> Column:
    """What follows a reply: ``EXECUTE:``, ``COMPENSATE:`` or ``RETRY:`` with a step, or ``COMPLETE:``
    with a status. ``statuses`` and ``retries`` hold the step states once the reply is applied."""

    def compensate_before(order: int, otherwise: str) -> Column:
        chain = None
        for s in reversed(PAYMENT_STEPS[:order]):
            if s.step_type == "COMPENSABLE" and s.compensable:
                done = statuses[s.name] == "COMPLETED"
                chain = F.when(done, f"COMPENSATE:{s.name}") if chain is None else chain.when(done, f"COMPENSATE:{s.name}")
        return F.lit(otherwise) if chain is None else chain.otherwise(otherwise)

    result = None
    for s in PAYMENT_STEPS:
        following = PAYMENT_STEPS[s.order + 1 :]
        forward = F.lit(f"EXECUTE:{following[0].name}" if following else "COMPLETE:COMPLETED")
        if s.step_type == "RETRYABLE":
            failed = F.when(retries[s.name] < s.max_retries, f"RETRY:{s.name}").otherwise("COMPLETE:FAILED")
        else:
            failed = compensate_before(s.order, "COMPLETE:COMPENSATED")
        undone = F.when(ok, compensate_before(s.order, "COMPLETE:COMPENSATED")).otherwise(
            compensate_before(s.order, "COMPLETE:FAILED")
        )
        action = F.when(is_compensation, undone).when(ok, forward).otherwise(failed)
        result = F.when(step == s.name, action) if result is None else result.when(step == s.name, action)
    return result


def saga_stats(instances: DataFrame) -> DataFrame:
    def count(*statuses: str) -> Column:
        return F.count_if(F.col("status").isin(*statuses))

    return instances.agg(
        F.count(F.lit(1)).alias("total"),
        count("STARTED", "EXECUTING").alias("active"),
        count("COMPLETED").alias("completed"),
        count("COMPENSATED").alias("compensated"),
        count("FAILED").alias("failed"),
    )


def outcome_of(event_type: Column) -> Column:
    return F.when(event_type.isin("SAGA_COMPLETED", "SAGA_FAILED", "SAGA_COMPENSATED"), F.substring(event_type, 6, 20))


def saga_outcomes(events: DataFrame) -> DataFrame:
    return (
        events.select(outcome_of(F.col("event_type")).alias("outcome"))
        .filter(F.col("outcome").isNotNull())
        .groupBy("outcome")
        .agg(F.count(F.lit(1)).alias("sagas"))
    )


def _durations(instances: DataFrame) -> DataFrame:
    return instances.filter(F.col("completed_at").isNotNull()).select(
        "saga_type",
        F.lower("status").alias("outcome"),
        "completed_at",
        (F.unix_millis("completed_at") - F.unix_millis("created_at")).alias("ms"),
    )


def saga_duration_p95(instances: DataFrame, share: float = 0.95, window: str = "5 minutes", **tuning) -> DataFrame:
    """Exact percentile of finished sagas' duration in seconds by type, outcome and completion window."""
    finished = _durations(instances).withColumn("window_start", F.window("completed_at", window)["start"]).drop("completed_at")
    keys = ["saga_type", "outcome", "window_start"]
    ranked = exact_percentile(finished, keys, "ms", share, "ms", width=60_000, **tuning)
    return ranked.select(*keys, (F.col("ms") / 1000).alias("p95_seconds"), "samples")


def saga_duration_partials(instances: DataFrame, slot_seconds: int = 300, **tuning) -> DataFrame:
    """Mergeable states of the durations by type, outcome and completion slot, in one pass. They can be stored and merged."""
    slot = F.floor(F.unix_seconds("completed_at") / slot_seconds).alias("slot")
    finished = _durations(instances).select("saga_type", "outcome", slot, (F.col("ms") / 1000).alias("_seconds"))
    return quantiles.partials(finished, ["saga_type", "outcome", "slot"], F.col("_seconds"), **tuning)


def saga_duration_quantiles(partials: DataFrame, share: float = 0.95, slot_seconds: int = 300, width: int = 1, **tuning) -> DataFrame:
    """Quantile of the durations over sliding windows of ``width`` slots: interpolated in buckets, and from the sketch."""
    keys = ["saga_type", "outcome", "slot"]
    seen = quantiles.merged(quantiles.sliding(partials, "slot", width), keys, **tuning)
    bounds = {k: v for k, v in tuning.items() if k == "bounds"}
    return seen.select(
        "saga_type",
        "outcome",
        F.timestamp_seconds((F.col("slot") + 1) * slot_seconds).alias("window_end"),
        quantiles.bucket_quantile(F.col("counts"), share, **bounds).alias("bucket_seconds"),
        quantiles.sketch_quantile(F.col("sketch"), share).alias("sketch_seconds"),
        "samples",
    )


def step_metrics(instances: DataFrame, steps: DataFrame) -> DataFrame:
    """Durations, retries and failures per step."""
    seconds = (F.unix_millis("completed_at") - F.unix_millis("started_at")) / 1000
    typed = steps.join(instances.select(F.col("id").alias("saga_instance_id"), "saga_type"), "saga_instance_id")
    return typed.groupBy("saga_type", "step_name", "step_type").agg(
        F.count(seconds).alias("runs"),
        F.avg(seconds).alias("avg_seconds"),
        F.max(seconds).alias("max_seconds"),
        F.sum("retry_count").alias("retries"),
        F.count_if(F.col("status") == "FAILED").alias("failures"),
    )


def active_sagas(events: DataFrame, **tuning) -> DataFrame:
    """Gauges over time by saga type, one row per instant with a change.

    ``compensating`` rises with every compensated step and falls once per compensated saga;
    ``distinct_sagas`` rises once per saga. Changes are added up per instant before they are ordered.
    """
    kind = F.col("event_type")
    ended = kind.isin("SAGA_COMPLETED", "SAGA_COMPENSATED", "SAGA_FAILED")
    zero = F.lit(0).cast("long")

    def delta(up: Column, down: Column) -> Column:
        return F.when(up, F.lit(1)).when(down, F.lit(-1)).otherwise(F.lit(0)).cast("long")

    changes = events.select(
        "saga_type",
        F.unix_millis("occurred_at").alias("ms"),
        delta(kind == "SAGA_STARTED", ended).alias("active"),
        delta(kind == "STEP_COMPENSATED", kind == "SAGA_COMPENSATED").alias("compensating"),
        delta(F.lit(False), kind == "SAGA_COMPENSATED").alias("distinct_sagas"),
    )
    entered = (
        events.filter(kind == "STEP_COMPENSATED")
        .groupBy("saga_type", "saga_id")
        .agg(F.unix_millis(F.min("occurred_at")).alias("ms"))
        .select("saga_type", "ms", zero.alias("active"), zero.alias("compensating"), F.lit(1).cast("long").alias("distinct_sagas"))
    )
    gauges = ["active", "compensating", "distinct_sagas"]
    per_instant = (
        changes.unionByName(entered)
        .groupBy("saga_type", "ms")
        .agg(*[F.sum(g).alias(g) for g in gauges], F.max(F.greatest(*[F.abs(g) for g in gauges])).alias("_moved"))
        .filter(F.col("_moved") > 0)
        .drop("_moved")
    )
    totals = running_totals(per_instant, ["saga_type"], ["ms"], "ms", gauges, 24 * _HOUR_MS, **tuning)
    return totals.select("saga_type", F.timestamp_millis("ms").alias("at"), *gauges)


def latest_status(events: DataFrame) -> DataFrame:
    """Newest status per saga, over all events and over lifecycle (``SAGA_*``) events only."""
    own = F.col("event_type").startswith("SAGA_")
    return (
        events.filter(F.col("status").isNotNull())
        .groupBy("saga_id")
        .agg(
            F.max(F.struct("seq", "status")).alias("_any"),
            F.max(F.when(own, F.struct("seq", "status"))).alias("_own"),
        )
        .select("saga_id", F.col("_any.status").alias("last_status"), F.col("_own.status").alias("saga_status"))
    )


def saga_of_payment(events: DataFrame) -> DataFrame:
    return (
        events.filter(F.col("payment_id").isNotNull())
        .groupBy("payment_id")
        .agg(F.max(F.struct("seq", "saga_id"))["saga_id"].alias("saga_id"))
    )


def payments_with_saga(payments: DataFrame, events: DataFrame) -> DataFrame:
    """Payments with the newest saga that names them and its newest status."""
    state = saga_of_payment(events).join(latest_status(events), "saga_id", "left")
    return salted_join(payments, state, ["payment_id"], "left")


def stuck_sagas(failures: DataFrame, instances: DataFrame, limit: int | None = None) -> DataFrame:
    """Unresolved failures and problem sagas without a failure record; a ``limit`` takes the newest of them all."""
    known = instances.select("saga_id", "saga_type", "status", "current_step")
    recorded = failures.filter(~F.col("resolved")).join(known, "saga_id", "left").select(
        "saga_id",
        F.coalesce("saga_type", F.lit("unknown")).alias("saga_type"),
        F.coalesce("status", F.lit("FAILED")).alias("status"),
        "current_step",
        "reason",
        F.col("created_at").alias("created_at"),
        "resolved",
    )
    problems = instances.filter(F.col("status").isin("FAILED", "COMPENSATING"))
    unrecorded = problems.join(failures.select("saga_id"), "saga_id", "left_anti").select(
        "saga_id",
        "saga_type",
        "status",
        "current_step",
        F.concat(F.lit("Saga in "), F.col("status"), F.lit(" state")).alias("reason"),
        F.col("updated_at").alias("created_at"),
        F.lit(False).alias("resolved"),
    )
    stuck = recorded.unionByName(unrecorded)
    return stuck if limit is None else stuck.orderBy(F.col("created_at").desc(), "saga_id").limit(limit)


def compensation_failures(log: DataFrame) -> DataFrame:
    """State of the failure ledger: a new failure re-opens, a resolve closes what exists."""
    failed = F.col("action") == "FAILED"
    newest = F.max(F.when(failed, F.struct("seq", "reason", "payload", "at")))
    return (
        log.groupBy("saga_id")
        .agg(newest.alias("_f"), F.max(F.when(~failed, F.col("seq"))).alias("_resolved"))
        .filter(F.col("_f").isNotNull())
        .select(
            "saga_id",
            "_f.reason",
            "_f.payload",
            F.col("_f.at").alias("created_at"),
            F.coalesce(F.col("_resolved") > F.col("_f.seq"), F.lit(False)).alias("resolved"),
        )
    )


def timed_out_steps(
    steps: DataFrame, instances: DataFrame, as_of: Column, timeout_seconds: int = TIMEOUT_SECONDS, per_step: bool = False
) -> DataFrame:
    """Failure replies for steps that execute for too long; ``per_step`` uses each step's own timeout."""
    seconds = F.lit(timeout_seconds)
    if per_step:
        own = None
        for s in PAYMENT_STEPS:
            test = F.col("step_name") == s.name
            own = F.when(test, s.timeout_seconds) if own is None else own.when(test, s.timeout_seconds)
        seconds = own.otherwise(timeout_seconds)
    late = steps.filter(
        (F.col("status") == "EXECUTING") & (F.unix_millis("started_at") < F.unix_millis(as_of) - seconds * 1000)
    ).withColumn("_seconds", seconds)
    sagas = instances.select(F.col("id").alias("saga_instance_id"), "saga_id")
    return late.join(sagas, "saga_instance_id").select(
        "saga_id",
        "step_name",
        F.lit("FAILURE").alias("status"),
        F.concat(F.lit("Step timed out after "), F.col("_seconds").cast("string"), F.lit("s")).alias("error_message"),
        F.lit(False).alias("is_compensation"),
    )


def saga_steps(instances: DataFrame, steps: DataFrame) -> DataFrame:
    """Steps with the id of their saga. An instance has one row per step of its definition, so neither
    side of this join can be hot."""
    sagas = instances.select(F.col("id").alias("saga_instance_id"), "saga_id")
    return steps.join(sagas, "saga_instance_id").select(
        "saga_id", "step_order", "step_name", "step_type", "status", "retry_count", "error_message", "started_at", "completed_at"
    )


def saga_detail(instances: DataFrame, steps: DataFrame) -> DataFrame:
    """Instances with their ordered steps. A step name occurs once per saga (its newest row), so the
    list is as long as the definition."""
    unique = first_per_key(steps, ["saga_instance_id", "step_name"], F.col("id").desc())
    item = F.struct("step_order", "step_name", "step_type", "status", "retry_count", "error_message", "started_at", "completed_at")
    nested = unique.groupBy("saga_instance_id").agg(F.sort_array(F.collect_list(item)).alias("steps"))
    return instances.join(nested.withColumnRenamed("saga_instance_id", "id"), "id", "left")


def payment_full(payments: DataFrame, instances: DataFrame, steps: DataFrame) -> DataFrame:
    """Payments with a summary of their saga and its steps."""
    sagas = saga_detail(instances, steps).select(
        payload_payment_id(F.col("payload")).alias("payment_id"),
        F.struct("saga_id", "saga_type", "status", "current_step", "created_at", "updated_at", "steps").alias("saga"),
    )
    return salted_join(payments, first_per_key(sagas, ["payment_id"], F.col("saga.created_at").desc()), ["payment_id"], "left")


def step_timeline(instances: DataFrame, steps: DataFrame, events: DataFrame) -> DataFrame:
    """Step snapshots overlaid by events: the newest event gives the attempt, the newest with a status
    the status. The saga's own status is that of its newest ``SAGA_*`` event, else the snapshot's."""
    snapshot = saga_steps(instances, steps).select(
        "saga_id", "step_name", F.col("status").alias("_status"), (F.col("retry_count") + 1).alias("_attempts")
    )
    overlay = (
        events.filter(F.col("step_name").isNotNull())
        .groupBy("saga_id", "step_name")
        .agg(
            F.max(F.struct("occurred_at", "seq", "attempt")).alias("_newest"),
            F.max(F.when(F.col("status").isNotNull(), F.struct("occurred_at", "seq", "status"))).alias("_stated"),
        )
    )
    own = (
        events.filter(F.col("event_type").startswith("SAGA_") & F.col("status").isNotNull())
        .groupBy("saga_id")
        .agg(F.max(F.struct("occurred_at", "seq", "status"))["status"].alias("_own"))
    )
    merged = snapshot.join(overlay, ["saga_id", "step_name"], "full")
    state = instances.select("saga_id", F.col("status").alias("_snapshot")).join(own, "saga_id", "full")
    return merged.join(state, "saga_id", "left").select(
        "saga_id",
        "step_name",
        F.coalesce("_stated.status", "_status", F.lit("PENDING")).alias("status"),
        F.coalesce("_newest.attempt", "_attempts").alias("attempts"),
        F.coalesce("_own", "_snapshot").alias("saga_status"),
    )


def saga_payload(replies: DataFrame) -> DataFrame:
    """Data folded from the newest successful reply of each step, one row per saga."""
    fields = sorted({s.reply_field for s in PAYMENT_STEPS})
    ok = replies.filter((F.col("status") == "SUCCESS") & ~F.col("is_compensation"))
    ok = J.with_document(ok, "payload", "_doc", fields)
    columns = []
    for s in PAYMENT_STEPS:
        kind = J.kind(F.col("_doc"), s.reply_field)
        if s.reply_field == "score":
            value = F.when(kind.isNotNull(), F.coalesce(J.coerced_double(F.col("_doc"), s.reply_field), F.lit(0.0)))
        else:
            value = F.when(kind == "VOID", "null").otherwise(J.value(F.col("_doc"), s.reply_field, "string"))
        newest = F.max(F.when(F.col("step_name") == s.name, F.struct("seq", value.alias("v"))))
        columns.append(newest["v"].alias(s.payload_field))
    return ok.groupBy("saga_id").agg(*columns)
