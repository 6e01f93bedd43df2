"""The warehouse refresh on disk, its checks, and the table sink."""

import os

import pytest
from pyspark.sql import functions as F

from tillwarden.operators import landing, monitoring
from tillwarden.plans import refresh as R
from tillwarden.session import shared_dir
from tillwarden.sources import samples as S
from tillwarden.sources.tables import write_table


@pytest.fixture(scope="module")
def tables(spark, data):
    twice = S.payments(spark, data).withColumnRenamed("seq", "offset")
    stale = twice.withColumns({"offset": F.col("offset") - 10**6, "currency": F.lit("OLD")})
    raw = {
        "payment_events": twice.unionByName(stale),
        "fraud_alerts": S.alerts_raw(spark, data, second=True),
        "payment_metrics_hourly": monitoring.hourly_metrics(S.payments(spark, data)),
        "saga_events": S.saga_events(spark, data),
    }
    # lifecycles are of the 1990s: by this day none has expired
    as_of = F.lit("1992-01-31 00:00:00").cast("timestamp")
    return R.refresh(spark, raw, shared_dir(spark, "warehouse"), as_of)


def test_all_checks_pass(tables):
    report = R.check_report(tables)
    assert R.failing(report).collect() == []
    assert report.count() == sum(map(len, [*R.NOT_NULL.values(), *R.UNIQUE.values(), *R.POSITIVE.values(), *R.SCORES.values()])) + len(R.RELATIONS) + 1


def test_replaced_rows_are_gone(tables):
    assert {r.currency for r in tables["fct_payments"].select("currency").distinct().collect()} == {"USD", "EUR", "GBP"}
    assert tables["fct_payments"].count() == 1000


def test_checks_find_faults(tables):
    broken = dict(tables)
    broken["fct_payments"] = tables["fct_payments"].withColumn("amount", -F.col("amount"))
    broken["dim_currency"] = tables["dim_currency"].filter("currency_code = 'USD'")
    names = {r.check_name for r in R.failing(R.check_report(broken)).collect()}
    assert names == {"fct_payments.amount.positive_amount", "fct_payments.currency_sk.relationships"}


def test_month_folders_and_pruning(spark, data):
    path = shared_dir(spark, "months")
    write_table(S.saga_events(spark, data), path, "event_date", ["saga_id"])
    months = [d for d in os.listdir(path) if d.startswith("month=")]
    assert len(months) > 12
    one = spark.read.parquet(path).filter("month = '199503'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_sink_records(spark, data):
    records = landing.metric_records(monitoring.hourly_metrics(S.payments(spark, data)))
    first = records.orderBy("key").first()
    start, currency = first.key.split(":")
    assert start.isdigit() and currency in ("USD", "EUR", "GBP") and '"windowStartEpochMs":' + start in first.value
    letters = spark.createDataFrame([("x", "e", None)], "raw string, error string, occurred_at timestamp")
    assert landing.dead_letter_records(letters).first().key is None


def test_dedup_thins_copies_before_the_shuffle(spark, data):
    plan = landing.dedup_first(S.payment_arrivals(spark, data), ["event_id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
