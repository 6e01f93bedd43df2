"""Lifecycle queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import literal_time
from ..functions.jsonfields import json_or_null
from ..operators import lifecycle as G
from ..operators import serving as V
from ..sources import samples as S
from ..sources.schemas import PAYMENT_STEPS
from .base import query

AS_OF = S.ORDERS_AS_OF


def _inputs(spark, folder):
    return S.saga_instances(spark, folder), S.saga_steps(spark, folder)


@query(
    "saga_stats",
    """SELECT count(*) AS total, count(*) FILTER (status IN ('STARTED','EXECUTING')) AS active, count(*) FILTER (status='COMPLETED') AS completed,
      count(*) FILTER (status='COMPENSATED') AS compensated, count(*) FILTER (status='FAILED') AS failed FROM inst""",
)
def _(spark, folder):
    return G.saga_stats(S.saga_instances(spark, folder))


@query(
    "saga_outcomes",
    "SELECT substr(event_type,6) AS outcome, count(*) AS sagas FROM sev WHERE event_type IN ('SAGA_COMPLETED','SAGA_FAILED','SAGA_COMPENSATED') GROUP BY 1",
)
def _(spark, folder):
    return G.saga_outcomes(S.saga_events(spark, folder))


@query(
    "saga_duration_p95",
    """SELECT saga_type, lower(status) AS outcome, make_timestamp(CAST(floor(epoch(completed_at)/2592000) AS BIGINT)*2592000*1000000) AS window_start,
      round(quantile_cont(epoch_ms(completed_at)-epoch_ms(created_at), 0.95)/1000, 6) AS p95_seconds, count(*) AS samples
    FROM inst WHERE completed_at IS NOT NULL GROUP BY ALL""",
)
def _(spark, folder):
    """Orders are sparse, so the window is 30 days instead of five minutes."""
    result = G.saga_duration_p95(S.saga_instances(spark, folder), window="30 days")
    return result.withColumn("p95_seconds", F.round("p95_seconds", 6))


#: Orders finish within minutes; the windows are of 30 days in steps of ten.
_SLOT, _WIDTH, _BOUNDS = 864_000, 3, (1.0, 5.0, 20.0, 60.0, 120.0, 600.0)


@query(
    "saga_duration_quantiles",
    f"""WITH v AS (SELECT lower(status) AS outcome, CAST(floor(epoch(completed_at) / {_SLOT}) AS BIGINT) AS s, (epoch_ms(completed_at) - epoch_ms(created_at)) / 1000 AS d
      FROM inst WHERE completed_at IS NOT NULL),
    w AS (SELECT outcome, s + unnest(range({_WIDTH})) AS s, d FROM v),
    n AS (SELECT outcome, s, count(*) AS samples FROM w GROUP BY 1, 2),
    b AS (SELECT n.outcome, n.s, samples, le, lag(le, 1, 0) OVER (PARTITION BY n.outcome, n.s ORDER BY le) AS low,
        (SELECT count(*) FROM w WHERE w.outcome = n.outcome AND w.s = n.s AND d <= le) AS c FROM n, (VALUES {", ".join(f"({b}e0)" for b in _BOUNDS)}) x(le)),
    p AS (SELECT *, lag(c, 1, 0) OVER (PARTITION BY outcome, s ORDER BY le) AS c0 FROM b),
    q AS (SELECT outcome, s, arg_min(CASE WHEN c > c0 THEN low + (le - low) * (0.95e0 * samples - c0) / (c - c0) ELSE le END, le) FILTER (c >= 0.95e0 * samples) AS v FROM p GROUP BY 1, 2)
    SELECT 'PaymentSaga' AS saga_type, outcome, make_timestamp((s + 1) * {_SLOT} * 1000000) AS window_end, round(coalesce(v, {_BOUNDS[-1]}e0), 6) AS bucket_seconds, samples FROM n JOIN q USING (outcome, s)""",
)
def _(spark, folder):
    """The sketches are random, so tests bound their error against the exact percentile instead."""
    partials = G.saga_duration_partials(S.saga_instances(spark, folder), _SLOT, bounds=_BOUNDS)
    found = G.saga_duration_quantiles(partials, 0.95, _SLOT, _WIDTH, bounds=_BOUNDS)
    return found.drop("sketch_seconds").withColumn("bucket_seconds", F.round("bucket_seconds", 6))


@query(
    "step_metrics",
    """SELECT 'PaymentSaga' AS saga_type, step_name, step_type, count(completed_at) AS runs,
      round(avg((epoch_ms(completed_at)-epoch_ms(started_at))/1000),6) AS avg_seconds, max((epoch_ms(completed_at)-epoch_ms(started_at))/1000) AS max_seconds,
      CAST(sum(retry_count) AS BIGINT) AS retries, count(*) FILTER (status='FAILED') AS failures FROM stp GROUP BY ALL""",
)
def _(spark, folder):
    return G.step_metrics(*_inputs(spark, folder)).withColumn("avg_seconds", F.round("avg_seconds", 6))


@query(
    "active_sagas",
    """WITH d AS (
        SELECT occurred_at AS t, CASE WHEN event_type='SAGA_STARTED' THEN 1 WHEN event_type IN ('SAGA_COMPLETED','SAGA_FAILED','SAGA_COMPENSATED') THEN -1 ELSE 0 END AS a,
          CASE event_type WHEN 'STEP_COMPENSATED' THEN 1 WHEN 'SAGA_COMPENSATED' THEN -1 ELSE 0 END AS c,
          CASE event_type WHEN 'SAGA_COMPENSATED' THEN -1 ELSE 0 END AS s FROM sev
        UNION ALL SELECT min(occurred_at), 0, 0, 1 FROM sev WHERE event_type='STEP_COMPENSATED' GROUP BY saga_id),
      i AS (SELECT t, sum(a) AS a, sum(c) AS c, sum(s) AS s FROM d GROUP BY 1 HAVING sum(a)<>0 OR sum(c)<>0 OR sum(s)<>0)
    SELECT 'PaymentSaga' AS saga_type, t AS "at", CAST(sum(a) OVER w AS BIGINT) AS active, CAST(sum(c) OVER w AS BIGINT) AS compensating,
      CAST(sum(s) OVER w AS BIGINT) AS distinct_sagas FROM i WINDOW w AS (ORDER BY t ROWS UNBOUNDED PRECEDING)""",
)
def _(spark, folder):
    return G.active_sagas(S.saga_events(spark, folder))


@query(
    "saga_latest_status",
    """SELECT saga_id, arg_max(status, seq) AS last_status, arg_max(status, seq) FILTER (event_type LIKE 'SAGA_%') AS saga_status FROM sev GROUP BY 1""",
)
def _(spark, folder):
    return G.latest_status(S.saga_events(spark, folder))


@query(
    "payments_with_saga",
    """WITH s AS (SELECT payment_id, arg_max(saga_id, seq) AS saga_id FROM sev GROUP BY 1),
      l AS (SELECT saga_id, arg_max(status, seq) AS last_status, arg_max(status, seq) FILTER (event_type LIKE 'SAGA_%') AS saga_status FROM sev GROUP BY 1)
    SELECT event_id, p.payment_id, s.saga_id, last_status, saga_status FROM pay p LEFT JOIN s ON s.payment_id=p.payment_id LEFT JOIN l ON l.saga_id=s.saga_id""",
)
def _(spark, folder):
    """Payments whose numbers are those of an order have a saga; the others have none."""
    joined = G.payments_with_saga(S.payments(spark, folder), S.saga_events(spark, folder))
    return joined.select("event_id", "payment_id", "saga_id", "last_status", "saga_status")


@query(
    "stuck_sagas",
    """WITH f AS (SELECT * FROM cfail WHERE NOT resolved),
      p AS (SELECT * FROM inst WHERE status IN ('FAILED','COMPENSATING'))
    SELECT saga_id, coalesce(saga_type,'unknown') AS saga_type, coalesce(status,'FAILED') AS status, current_step, reason, f.created_at AS created_at, resolved
    FROM f LEFT JOIN (SELECT saga_id, saga_type, status, current_step FROM inst) USING (saga_id)
    UNION ALL SELECT saga_id, saga_type, status, current_step, 'Saga in '||status||' state', updated_at, false FROM p
    WHERE saga_id NOT IN (SELECT saga_id FROM cfail)""",
)
def _(spark, folder):
    failures = G.compensation_failures(S.compensation_log(spark, folder))
    return G.stuck_sagas(failures, S.saga_instances(spark, folder))


@query("compensation_failures", "SELECT saga_id, reason, payload, created_at, resolved FROM cfail")
def _(spark, folder):
    return G.compensation_failures(S.compensation_log(spark, folder))


@query(
    "timed_out_steps",
    f"""SELECT saga_id, step_name, 'FAILURE' AS status, 'Step timed out after 30s' AS error_message, false AS is_compensation
    FROM stp WHERE status='EXECUTING' AND started_at < TIMESTAMP '1999-01-01' - INTERVAL 30 SECOND""",
)
def _(spark, folder):
    instances, steps = _inputs(spark, folder)
    return G.timed_out_steps(steps, instances, literal_time("1999-01-01 00:00:00"))


@query(
    "saga_steps",
    "SELECT saga_id, step_order, step_name, step_type, status, retry_count, error_message, started_at, completed_at FROM stp",
)
def _(spark, folder):
    return G.saga_steps(*_inputs(spark, folder))


def _step_text(steps):
    """Ordered steps as text, so that nested rows compare in any engine."""
    return F.array_join(
        F.transform(steps, lambda s: F.concat_ws(":", s["step_name"], s["status"], s["retry_count"].cast("string"))), ","
    )


_STEP_TEXT = """
  t AS (SELECT saga_instance_id AS id, string_agg(step_name||':'||status||':'||retry_count, ',' ORDER BY step_order) AS steps FROM stp GROUP BY 1)"""


@query(
    "saga_detail",
    f"WITH {_STEP_TEXT} SELECT id, saga_id, status, current_step, created_at, completed_at, t.steps AS steps FROM inst JOIN t USING (id)",
)
def _(spark, folder):
    detail = G.saga_detail(*_inputs(spark, folder))
    return detail.select("id", "saga_id", "status", "current_step", "created_at", "completed_at", _step_text(F.col("steps")).alias("steps"))


@query(
    "payment_full",
    f"""WITH {_STEP_TEXT}, s AS (SELECT 'pay-'||id AS payment_id, saga_id, status AS saga_status, t.steps AS steps FROM inst JOIN t USING (id))
    SELECT event_id, p.payment_id, account_id, saga_id, saga_status, steps FROM pay p LEFT JOIN s ON s.payment_id=p.payment_id""",
)
def _(spark, folder):
    full = G.payment_full(S.payments(spark, folder), *_inputs(spark, folder))
    return full.select(
        "event_id", "payment_id", "account_id", F.col("saga.saga_id").alias("saga_id"), F.col("saga.status").alias("saga_status"),
        _step_text(F.col("saga.steps")).alias("steps"),
    )


@query(
    "step_timeline",
    """WITH e AS (SELECT saga_id, step_name, arg_max(attempt, seq) AS attempt, arg_max(status, seq) AS st FROM sev WHERE step_name IS NOT NULL GROUP BY 1,2),
      o AS (SELECT saga_id, arg_max(status, seq) AS own FROM sev WHERE event_type LIKE 'SAGA_%' GROUP BY 1)
    SELECT saga_id, step_name, coalesce(e.st, s.status, 'PENDING') AS status, CAST(coalesce(e.attempt, s.retry_count+1) AS INT) AS attempts, own AS saga_status
    FROM stp s FULL JOIN e USING (saga_id, step_name) LEFT JOIN o USING (saga_id)""",
)
def _(spark, folder):
    instances, steps = _inputs(spark, folder)
    return G.step_timeline(instances, steps, S.saga_events(spark, folder))


@query(
    "saga_payload",
    """SELECT saga_id, max(CASE WHEN step_name='FRAUD_CHECK' THEN 0.12e0 END) AS "fraudScore", max(CASE WHEN step_name='RISK_SCORING' THEN 0.2e0 END) AS "riskScore",
      max(CASE WHEN step_name='LEDGER_APPLY' THEN 'led-'||key END) AS "ledgerEventId", max(CASE WHEN step_name='NOTIFY' THEN 'ntf-'||key END) AS "notificationId"
    FROM rep WHERE event_type='STEP_COMPLETED' GROUP BY 1""",
)
def _(spark, folder):
    return G.saga_payload(S.saga_replies(spark, folder))


@query(
    "step_status",
    """SELECT saga_id, seq, CASE WHEN status='FAILURE' THEN 'FAILED' WHEN is_compensation THEN 'COMPENSATED' ELSE 'COMPLETED' END AS step_status FROM rep""",
)
def _(spark, folder):
    r = S.saga_replies(spark, folder)
    return r.select("saga_id", "seq", G.step_status(F.col("status") == "SUCCESS", F.col("is_compensation")).alias("step_status"))


@query(
    "saga_event_types",
    """SELECT saga_id, step_name, CASE WHEN status IN ('COMPLETED','COMPENSATED','FAILED') THEN 'STEP_'||status ELSE 'STEP_UPDATE' END AS step_event,
      CASE WHEN status IN ('COMPLETED','COMPENSATED','FAILED') THEN 'SAGA_'||status ELSE 'SAGA_UPDATE' END AS saga_event FROM stp""",
)
def _(spark, folder):
    s = G.saga_steps(*_inputs(spark, folder))
    status = F.col("status")
    return s.select(
        "saga_id", "step_name", G.step_event_type(status).alias("step_event"), G.saga_event_type(status).alias("saga_event")
    )


@query("payload_payment_id", "SELECT saga_id, CASE WHEN id%9=0 THEN NULL ELSE 'pay-'||id END AS payment_id FROM inst")
def _(spark, folder):
    i = S.saga_instances(spark, folder)
    payload = F.when(F.col("id") % 9 == 0, F.expr("substring(payload, 3)")).otherwise(F.col("payload"))
    return i.select("saga_id", G.payload_payment_id(payload).alias("payment_id"))


@query(
    "saga_next_action",
    """WITH w AS (SELECT saga_id, max(status) FILTER (step_name='FRAUD_CHECK') AS f, max(status) FILTER (step_name='RISK_SCORING') AS r,
        max(retry_count) FILTER (step_name='NOTIFY') AS n FROM stp GROUP BY 1)
    SELECT saga_id, seq, CASE
      WHEN is_compensation THEN CASE WHEN step_name IN ('RISK_SCORING','LEDGER_APPLY','NOTIFY') AND step_name<>'RISK_SCORING' AND r='COMPLETED' THEN 'COMPENSATE:RISK_SCORING'
        WHEN step_name<>'FRAUD_CHECK' AND f='COMPLETED' THEN 'COMPENSATE:FRAUD_CHECK' WHEN status='SUCCESS' THEN 'COMPLETE:COMPENSATED' ELSE 'COMPLETE:FAILED' END
      WHEN status='SUCCESS' THEN CASE step_name WHEN 'FRAUD_CHECK' THEN 'EXECUTE:RISK_SCORING' WHEN 'RISK_SCORING' THEN 'EXECUTE:LEDGER_APPLY'
        WHEN 'LEDGER_APPLY' THEN 'EXECUTE:NOTIFY' ELSE 'COMPLETE:COMPLETED' END
      WHEN step_name='NOTIFY' THEN CASE WHEN n<3 THEN 'RETRY:NOTIFY' ELSE 'COMPLETE:FAILED' END
      WHEN step_name='LEDGER_APPLY' AND r='COMPLETED' THEN 'COMPENSATE:RISK_SCORING'
      WHEN step_name IN ('LEDGER_APPLY','RISK_SCORING') AND f='COMPLETED' THEN 'COMPENSATE:FRAUD_CHECK' ELSE 'COMPLETE:COMPENSATED' END AS next_action
    FROM rep JOIN w USING (saga_id)""",
)
def _(spark, folder):
    """The action after each reply, were the steps in their final state."""
    steps = G.saga_steps(*_inputs(spark, folder))
    wide = steps.groupBy("saga_id").agg(
        *[F.max(F.when(F.col("step_name") == s.name, F.col("status"))).alias(f"_s_{s.name}") for s in PAYMENT_STEPS],
        *[F.max(F.when(F.col("step_name") == s.name, F.col("retry_count"))).alias(f"_r_{s.name}") for s in PAYMENT_STEPS],
    )
    statuses = {s.name: F.col(f"_s_{s.name}") for s in PAYMENT_STEPS}
    retries = {s.name: F.col(f"_r_{s.name}") for s in PAYMENT_STEPS}
    action = G.next_action(F.col("step_name"), F.col("status") == "SUCCESS", F.col("is_compensation"), statuses, retries)
    return S.saga_replies(spark, folder).join(wide, "saga_id").select("saga_id", "seq", action.alias("next_action"))


@query(
    "saga_list",
    "SELECT saga_id, status, created_at FROM inst WHERE status='FAILED' ORDER BY created_at DESC, saga_id LIMIT 50 OFFSET 100",
)
def _(spark, folder):
    page = V.saga_list(S.saga_instances(spark, folder), "FAILED", "PaymentSaga", 50, 100)
    return page.select("saga_id", "status", "created_at")


@query("step_payload", "SELECT saga_id, CASE WHEN id%3<>0 THEN 'pay-'||id END AS payment_id, id%3=0 AS is_null FROM inst")
def _(spark, folder):
    """Payloads as JSON values; those of every third lifecycle are NULL."""
    instances, _ = _inputs(spark, folder)
    value = json_or_null(F.when(F.col("id") % 3 != 0, F.col("payload")))
    return instances.select("saga_id", F.try_variant_get(value, "$.paymentId", "string").alias("payment_id"), value.isNull().alias("is_null"))
