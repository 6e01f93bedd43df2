import datetime
from decimal import Decimal

from tillwarden.operators import landing, ledger, quality

UTC = datetime.timezone.utc
ARRIVALS = "event_id string, payment_id string, account_id string, currency string, amount decimal(19,4), occurred_at timestamp, arrival long"


def _at(*parts):
    return datetime.datetime(*parts, tzinfo=UTC)


def _arrivals(spark):
    rows = [
        ("e1", "p1", "acc-test", "USD", Decimal(10), _at(2026, 1, 10, 10), 1),
        ("e2", "p2", "acc-test", "USD", Decimal(5), _at(2026, 1, 11, 10), 2),
        ("e1", "p1", "acc-test", "USD", Decimal(10), _at(2026, 1, 10, 10), 3),
    ]
    return spark.createDataFrame(rows, ARRIVALS)


def test_balances(spark):
    unique = landing.dedup_first(_arrivals(spark), ["event_id"])
    events = ledger.balance_events(unique)
    assert [int(r.balance_after) for r in events.orderBy("arrival").collect()] == [10, 15]
    balance = ledger.account_balance(unique)
    assert int(balance.first().balance) == 15 and balance.first().last_source_event_id == "e2"
    probes = spark.createDataFrame(
        [(1, "acc-test", "USD", _at(2026, 1, 10, 12)), (2, "acc-test", "USD", _at(2026, 1, 9)), (3, "x", "USD", _at(2026, 1, 9))],
        "probe_id long, account_id string, currency string, at timestamp",
    )
    asof = {r.probe_id: (int(r.balance), r.as_of) for r in ledger.balance_asof(probes, events).collect()}
    assert asof[1] == (10, datetime.datetime(2026, 1, 10, 10))
    assert asof[2] == (0, datetime.datetime(2026, 1, 9)) and asof[3][0] == 0
    current = ledger.balance_current(probes.select("account_id", "currency").distinct(), balance)
    assert {r.account_id: (int(r.balance), r.as_of is None) for r in current.collect()} == {"acc-test": (15, False), "x": (0, True)}
    assert quality.balance_reconcile(balance, events).count() == 0


def test_hot_account_uses_cells(spark):
    rows = [(f"e{i}", "p", "hot", "USD", Decimal(i % 7), _at(2026, 1, 1) + datetime.timedelta(minutes=i), i) for i in range(300)]
    df = spark.createDataFrame(rows, ARRIVALS)
    got = {r.arrival: int(r.balance_after) for r in ledger.balance_events(df, width=11, limit=50).collect()}
    total = 0
    for i in range(300):
        total += i % 7
        assert got[i] == total


def test_merge_balances_names_the_newer_event(spark):
    unique = landing.dedup_first(_arrivals(spark), ["event_id"])
    first, second = ledger.account_balance(unique.filter("arrival = 1")), ledger.account_balance(unique.filter("arrival = 2"))
    merged = ledger.merge_balances(first, second).first()
    assert (int(merged.balance), merged.last_source_event_id) == (15, "e2")


def test_idempotency(spark):
    rows = [("k", "a", 1), ("k", "a", 2), ("k", "b", 3), (" ", "a", 4), (None, "a", 5), ("z", "b", 6)]
    df = spark.createDataFrame(rows, "idempotency_key string, body string, arrival int")
    for limit in (None, 1):
        got = {r.arrival: r.outcome for r in ledger.idempotency_outcome(df, limit).collect()}
        assert got == {1: "created", 2: "idempotent_hit", 3: "failed", 4: "created", 5: "created", 6: "created"}


def test_equal_arrivals_create_once(spark):
    df = spark.createDataFrame([("k", "a", 1), ("k", "a", 1), ("k", "b", 1)], "idempotency_key string, body string, arrival int")
    for limit in (None, 1):
        outcomes = sorted(r.outcome for r in ledger.idempotency_outcome(df, limit).collect())
        assert outcomes.count("created") == 1 and len(outcomes) == 3


def test_commands_of_one_payment_get_versions_in_order(spark):
    at = _at(2026, 1, 1)
    rows = [("s2", 7, "p", "a", Decimal(1), "USD", at), ("s1", 3, "p", "a", Decimal(1), "USD", at), ("s1", 9, "p", "a", Decimal(1), "USD", at)]
    commands = spark.createDataFrame(rows, "saga_id string, seq long, payment_id string, account_id string, amount decimal(19,4), currency string, occurred_at timestamp")
    stored = spark.createDataFrame([("p", 1)], "aggregate_id string, version int")
    got = {r.event_id: r.version for r in ledger.settled_events(commands, stored).collect()}
    assert sorted(got.values()) == [2, 3] and len(got) == 2


def test_command_replay_gives_stored_reply(spark):
    commands = spark.createDataFrame(
        [("s1", "L", 1, "r1"), ("s1", "L", 2, "r2"), ("s2", "L", 3, "r3")], "saga_id string, step_name string, seq long, reply_payload string"
    )
    stored = spark.createDataFrame([("s2", "L", "old")], "saga_id string, step_name string, reply_payload string")
    got = {r.seq: (r.outcome, r.reply_payload) for r in ledger.processed_commands(commands, stored).collect()}
    assert got == {1: ("executed", "r1"), 2: ("replayed", "r1"), 3: ("replayed", "old")}


def test_versions_continue(spark):
    schema = "id long, aggregate_id string, event_type string, version int, occurred_at timestamp"
    existing = spark.createDataFrame([(1, "p", "PaymentInitiatedV1", 1, _at(2026, 1, 1))], schema)
    appends = spark.createDataFrame([(2, "p", "x", None, _at(2026, 1, 2)), (3, "q", "x", None, _at(2026, 1, 2))], schema)
    got = {r.aggregate_id: r.version for r in ledger.event_versions(appends, existing).collect()}
    assert got == {"p": 2, "q": 1}
