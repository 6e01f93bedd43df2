import datetime
import json

import pytest
from pyspark.sql import functions as F

from tillwarden.operators import landing, parsing, rules
from tillwarden.sources.schemas import RAW_RECORD

NOW = datetime.datetime(2026, 1, 1)


def _records(spark, *values, keys=None):
    rows = [("t", 0, i, (keys or {}).get(i), v, NOW) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, RAW_RECORD)


def _payment(**changes):
    body = {"eventId": "e", "paymentId": "p", "accountId": "a", "amount": 99.5, "currency": "USD", "occurredAt": "2026-05-10T12:00:00Z"}
    body.update(changes)
    return json.dumps({k: v for k, v in body.items() if v != "-"})


def test_payment_and_dead_letters(spark):
    parsed = parsing.parse_payments(_records(spark, _payment(), '{"paymentId":"p1"}', "not-json"))
    good = parsing.valid_payments(parsed).collect()
    assert [(r.event_id, r.amount, str(r.occurred_at)) for r in good] == [("e", 99.5, "2026-05-10 12:00:00")]
    bad = {r.raw: r.error for r in parsing.dead_letters(parsed).collect()}
    assert bad == {'{"paymentId":"p1"}': "missing or blank field: eventId", "not-json": "invalid json"}


@pytest.mark.parametrize(
    "changes, want",
    [
        ({"eventId": 1}, "missing or blank field: eventId"),
        ({"accountId": " \t"}, "missing or blank field: accountId"),
        ({"amount": None}, "missing amount"),
        ({"amount": "-"}, "missing amount"),
        ({"amount": "12.5"}, 12.5),
        ({"amount": "abc"}, 0.0),
        ({"amount": True}, 1.0),
        ({"amount": [1]}, 0.0),
        ({"amount": 7}, 7.0),
    ],
)
def test_payment_field_types(spark, changes, want):
    row = parsing.parse_payments(_records(spark, _payment(**changes))).first()
    assert row.error == want if isinstance(want, str) else (row.error is None and row.amount == want)


def test_payment_defaults(spark):
    row = parsing.parse_payments(_records(spark, _payment(currency="", merchantId=" ", occurredAt="2026-05-10"))).first()
    assert (row.currency, row.merchant_id, row.occurred_at) == ("UNKNOWN", None, NOW)


def test_dead_letter_keeps_the_whole_record(spark):
    assert parsing.dead_letters(parsing.parse_payments(_records(spark, "x" * 5000))).first().raw == "x" * 5000


def test_strict_profile(spark):
    uuid = "0b1f6f0e-1111-4222-8333-444455556666"
    rows = parsing.parse_payments_strict(
        _records(
            spark, _payment(paymentId=uuid), _payment(), _payment(paymentId=uuid, currency="-"), _payment(paymentId=uuid, occurredAt="x")
        )
    ).orderBy("offset").collect()
    assert [r.error for r in rows] == [
        None, "paymentId is not a UUID", "missing or blank field: currency", "occurredAt is not an offset date-time"
    ]
    dlt = parsing.projection_dlt(parsing.parse_payments_strict(_records(spark, _payment()))).first()
    assert dlt.topic == "t.DLT"


def test_alert_profile(spark):
    body = {"alertId": "a", "userId": "u", "paymentId": "p", "reasons": ["x", 3, None, "y"], "occurredAtEpochMs": 1000}
    bad_time = {**body, "occurredAt": "tomorrow"}
    del bad_time["occurredAtEpochMs"]
    rows = parsing.parse_alerts(_records(spark, json.dumps(body), json.dumps(bad_time))).collect()
    assert [(r.score, r.reasons, r.rule_id) for r in rows] == [(0.0, ["x", "y"], "unknown")]


def test_rule_acks(spark):
    recs = _records(spark, '{"ruleId":"r1","version":3}', '{"version":2}', None, '{"ruleId":5,"version":"9"}', keys={1: "k1", 3: "k3"})
    got = [(r.rule_id, r.version) for r in parsing.parse_rule_acks(recs).orderBy("offset").collect()]
    assert got == [("r1", 3), ("k1", 2), ("k3", 1)]


def test_latest_version_is_order_safe(spark):
    acks = spark.createDataFrame([("r1", 1), ("r1", 3), ("r1", 2)], "rule_id string, version long")
    assert rules.rule_latest_version(acks).first().version == 3
    lead = rules.rule_acks_since(acks, "r1", 2).collect()
    assert (lead[0].version, lead[0].already_applied) == (3, True) and len(lead) == 3


GOOD_SPEC = {
    "maxAmount": 1, "velocityWindowMs": 1000, "velocityMaxCount": 1, "structuringThreshold": 0,
    "structuringWindowHours": 168, "structuringMinPayments": 2,
}


@pytest.mark.parametrize(
    "spec, want",
    [
        (json.dumps(GOOD_SPEC), ""),
        ("{not json", "json_spec is not valid JSON"),
        ("[1]", "json_spec is not an object"),
        (json.dumps({**GOOD_SPEC, "velocityWindowMs": 10}), "velocityWindowMs: must be at least 1000"),
        (json.dumps({**GOOD_SPEC, "bogus": 1}), "bogus: is not allowed"),
        (json.dumps({**GOOD_SPEC, "velocityMaxCount": 1.5}), "velocityMaxCount: must be an integer"),
        (json.dumps({**GOOD_SPEC, "maxAmount": "1"}), "maxAmount: must be a number"),
    ],
)
def test_rule_spec(spark, spec, want):
    df = spark.createDataFrame([(spec,)], "json_spec string")
    assert parsing.rule_spec_errors(df).first().errors == want


def test_rule_spec_lists_all_missing(spark):
    df = spark.createDataFrame([('{"maxAmount": 1}',)], "json_spec string")
    assert parsing.rule_spec_errors(df).first().errors.count("is required") == 5


def test_rule_payload_merges_spec(spark):
    df = spark.createDataFrame([("r1", 1, True, json.dumps(GOOD_SPEC))], "id string, version long, enabled boolean, json_spec string")
    assert json.loads(rules.rule_payload(df).first().payload) == {**GOOD_SPEC, "ruleId": "r1", "version": 1, "enabled": True}


def test_landing_is_lenient_on_missing_fields(spark):
    read = landing.read_payment_topic(_records(spark, '{"eventId":7,"amount":"1.25"}', "nope", '{"amount":{"x":1}}', "[]"))
    landed = landing.land_payments(read).collect()
    assert [(r.event_id, float(r.amount), r.account_id, str(r.occurred_at)) for r in landed] == [("7", 1.25, "", "1970-01-01 00:00:00")]
    assert landing.payment_dlq(read).count() == 3


def test_retention_edge(spark):
    df = spark.createDataFrame([(datetime.date(2024, 1, 1),), (datetime.date(2024, 1, 2),)], "d date")
    as_of = F.lit("2024-03-31 00:00:00").cast("timestamp")
    assert [str(r.d) for r in landing.retention_apply(df, "d", 90, as_of).collect()] == ["2024-01-02"]
