import datetime
import random

import pytest
from pyspark.sql import functions as F

from tillwarden.operators import automaton, lifecycle, replay, serving
from tillwarden.sources.schemas import PAYMENT_STEPS

LOG = "saga_id string, seq long, step_name string, status string, error_message string, is_compensation boolean, action string"
NAMES = [s.name for s in PAYMENT_STEPS]


def _log(spark, *entries, saga="s"):
    rows = []
    for i, e in enumerate(entries):
        if e in ("RETRY", "FORCE_COMPLETE"):
            rows.append((saga, i, None, None, None, None, e))
        else:
            step, ok = e[0], e[1]
            rows.append((saga, i, step, "SUCCESS" if ok else "FAILURE", None if ok else "no", len(e) > 2, None))
    return spark.createDataFrame(rows, LOG)


def _final(spark, *entries):
    done = replay.replay(_log(spark, *entries))
    saga = replay.saga_states(done).first()
    steps = {r.step_name: (r.status, r.retry_count) for r in replay.step_states(done).collect()}
    return saga.status, steps


def test_happy_path(spark):
    status, steps = _final(spark, *[(n, True) for n in NAMES])
    assert status == "COMPLETED" and {s for s, _ in steps.values()} == {"COMPLETED"}


def test_pivot_failure_compensates_without_retry(spark):
    status, steps = _final(
        spark, ("FRAUD_CHECK", True), ("RISK_SCORING", True), ("LEDGER_APPLY", False), ("RISK_SCORING", True, 1), ("FRAUD_CHECK", True, 1)
    )
    assert status == "COMPENSATED"
    assert [steps[n][0] for n in NAMES] == ["COMPENSATED", "COMPENSATED", "FAILED", "PENDING"]


def test_failed_compensation_goes_on_then_fails(spark):
    status, steps = _final(
        spark, ("FRAUD_CHECK", True), ("RISK_SCORING", True), ("LEDGER_APPLY", False), ("RISK_SCORING", False, 1)
    )
    assert status == "COMPENSATING" and steps["FRAUD_CHECK"][0] == "COMPENSATING"
    status, _ = _final(spark, ("FRAUD_CHECK", True), ("RISK_SCORING", False), ("FRAUD_CHECK", False, 1))
    assert status == "FAILED"


def test_retryable_step_uses_its_retries(spark):
    start = [("FRAUD_CHECK", True), ("RISK_SCORING", True), ("LEDGER_APPLY", True)]
    status, steps = _final(spark, *start, *[("NOTIFY", False)] * 3)
    assert status == "EXECUTING" and steps["NOTIFY"] == ("EXECUTING", 3)
    status, steps = _final(spark, *start, *[("NOTIFY", False)] * 4)
    assert status == "FAILED" and steps["NOTIFY"] == ("FAILED", 3)


def test_operator_actions(spark):
    assert _final(spark, ("FRAUD_CHECK", True), "FORCE_COMPLETE")[0] == "COMPLETED"
    status, steps = _final(spark, ("FRAUD_CHECK", True), "RETRY")
    assert status == "EXECUTING" and steps["RISK_SCORING"] == ("EXECUTING", 1)


def _random_log(rng, saga, n):
    rows = []
    for i in range(n):
        if rng.random() < 0.06:
            rows.append((saga, i, None, None, None, None, rng.choice(["RETRY", "RETRY", "FORCE_COMPLETE"])))
        else:
            step = rng.choice([*NAMES, "UNKNOWN"])
            ok = rng.random() < 0.55
            rows.append((saga, i, step, "SUCCESS" if ok else "FAILURE", None if ok else f"err{i}", rng.random() < 0.3, None))
    return rows


@pytest.mark.parametrize("seed", [11, 12])
def test_hot_saga_in_cells_equals_plain_fold(spark, seed):
    rng = random.Random(seed)
    rows = _random_log(rng, "hot", 180) + _random_log(rng, "cold", 20) + _random_log(rng, "tiny", 3)
    log = spark.createDataFrame(rows, LOG)
    columns = ["saga_id", "seq", "part", "record", "event_type", "step_name", "status", "attempt", "retry_count", "error_message"]

    def result(**tuning):
        return sorted(tuple(map(repr, r)) for r in replay.replay(log, **tuning).select(*columns).collect())

    assert result() == result(limit=50, width=7)


def _plain(rows):
    """The fold by a loop over the entries."""
    out = []
    for saga in {r[0] for r in rows}:
        log = sorted(r for r in rows if r[0] == saga)
        state = automaton.start_state(PAYMENT_STEPS)
        out.append((saga, log[0][1], 0, "SAGA_STARTED", None, "STARTED", 1))
        for _, seq, step, status, error, undo, action in log:
            if action or step in NAMES:
                index = NAMES.index(step) if step in NAMES else 0
                events = automaton.apply_entry(PAYMENT_STEPS, state, index, status == "SUCCESS", bool(undo), action, error)
                out += [(saga, seq, part, f"{kind}_{s}", NAMES[i], s, n) for part, (kind, s, i, n) in enumerate(events, 1)]
        out += [(saga, i, NAMES[i], state[0][i], state[1][i], state[2][i], state[3], NAMES[state[4]]) for i in range(len(NAMES))]
    return sorted(map(repr, out))


@pytest.mark.parametrize("tuning", [{}, {"limit": 40, "width": 11}, {"limit": 30, "width": 1}])
def test_replay_equals_a_plain_loop(spark, tuning, monkeypatch):
    """Cells of one row need several levels of blocks."""
    monkeypatch.setattr(replay, "BLOCK", 4)
    monkeypatch.setattr(replay, "CHUNK", 5)
    rng = random.Random(7)
    rows = _random_log(rng, "a", 150) + _random_log(rng, "b", 33) + _random_log(rng, "c", 1) + [("d", 5, "UNKNOWN", "SUCCESS", None, None, None)]
    done = replay.replay(spark.createDataFrame(rows, LOG), **tuning)
    found = [tuple(r) for r in replay.lifecycle_events(done).collect()] + [tuple(r) for r in replay.step_states(done).collect()]
    assert sorted(map(repr, found)) == _plain(rows)


def test_replay_stays_in_the_jvm(spark):
    done = replay.replay(spark.createDataFrame(_random_log(random.Random(1), "a", 90), LOG), limit=20, width=8)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_next_action_equals_fold(spark):
    """The column form against the fold, over every step, reply and state."""
    import itertools

    rows = []
    for name, ok, undo, f, r, n in itertools.product(NAMES, (True, False), (True, False), (True, False), (True, False), (0, 3)):
        rows.append((name, ok, undo, "COMPLETED" if f else "FAILED", "COMPLETED" if r else "FAILED", n))
    df = spark.createDataFrame(rows, "step string, ok boolean, undo boolean, f string, r string, n int")
    statuses = {"FRAUD_CHECK": F.col("f"), "RISK_SCORING": F.col("r")}
    retries = {"NOTIFY": F.col("n")}
    got = [r[0] for r in df.select(lifecycle.next_action(F.col("step"), F.col("ok"), F.col("undo"), statuses, retries)).collect()]
    for row, action in zip(rows, got):
        name, ok, undo, f, r, n = row
        state = [[f, r, "X", "X"], [0, 0, 0, n], [None] * 4, "EXECUTING", 0]
        before = [list(p) if isinstance(p, list) else p for p in state]
        events = automaton.apply_entry(PAYMENT_STEPS, state, NAMES.index(name), ok, undo, None, None)
        if len(events) == 2:
            want = f"COMPLETE:{events[1][1]}"
        else:
            verb = {"EXECUTING": "RETRY" if state[1] != before[1] else "EXECUTE", "COMPENSATING": "COMPENSATE"}[state[3]]
            want = f"{verb}:{NAMES[state[4]]}"
        assert action == want, row


EVENTS = "saga_id string, event_type string, status string, step_name string, payment_id string, attempt int, occurred_at timestamp, seq long"


def _event(seq, kind, status, step=None, saga="saga-1", payment="p1", attempt=1):
    return (saga, kind, status, step, payment, attempt, datetime.datetime(2026, 1, 1) + datetime.timedelta(seconds=seq), seq)


def test_live_status_mixes_but_saga_status_does_not(spark):
    events = spark.createDataFrame([_event(1, "SAGA_STARTED", "STARTED"), _event(2, "STEP_FAILED", "FAILED", "NOTIFY")], EVENTS)
    payments = spark.createDataFrame([("p1",), ("p2",)], "payment_id string")
    got = {r.payment_id: (r.saga_id, r.last_status, r.saga_status) for r in lifecycle.payments_with_saga(payments, events).collect()}
    assert got == {"p1": ("saga-1", "FAILED", "STARTED"), "p2": (None, None, None)}


def test_recent_payments(spark):
    df = spark.createDataFrame([("p1", 1), ("p2", 2), ("p3", 3)], "payment_id string, arrival long")
    assert [r.payment_id for r in serving.recent_payments(df, 2).collect()] == ["p3", "p2"]
    assert len(serving.recent_payments(df, 0).collect()) == 1


ALERTS = "alert_id string, user_id string, rule_id string, score double, occurred_at timestamp"


def _alerts(spark):
    now = datetime.datetime(2026, 1, 1, 12, 0, 30)
    return spark.createDataFrame([("a1", "acc-1", "rule-default", 0.9, now), ("a2", "acc-2", "high-amount", 0.5, now)], ALERTS)


def test_alert_filter(spark):
    alerts = _alerts(spark)
    assert serving.alerts_search(alerts, user="acc-1").count() == 1
    assert serving.alerts_search(alerts, rule_id="high-amount").count() == 1
    assert serving.alerts_search(alerts, min_score=0.8).first().alert_id == "a1"
    assert serving.alerts_search(alerts, user="ACC", min_score=0.6).count() == 1
    assert serving.alerts_search(alerts).count() == 2


def test_minute_buckets(spark):
    rows = serving.alerts_per_minute(_alerts(spark), F.lit("2026-01-01 12:00:45").cast("timestamp")).collect()
    assert len(rows) == 15 and rows[-1].minute == "12:00" and rows[-1].alerts == 2 and rows[0].minute == "11:46"


def test_failure_ledger_reopens(spark):
    t = datetime.datetime(2026, 1, 1)
    rows = [("s", 1, "FAILED", "r1", None, t), ("s", 2, "RESOLVED", None, None, t), ("s", 3, "FAILED", "r2", None, t), ("q", 1, "RESOLVED", None, None, t)]
    log = spark.createDataFrame(rows, "saga_id string, seq long, action string, reason string, payload string, at timestamp")
    got = lifecycle.compensation_failures(log).collect()
    assert [(r.saga_id, r.reason, r.resolved) for r in got] == [("s", "r2", False)]
