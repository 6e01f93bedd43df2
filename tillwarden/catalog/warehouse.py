"""Staging, dimensions, facts, marts and charts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import literal_time
from ..operators import serving as V
from ..operators import warehouse as W
from ..operators.monitoring import hourly_metrics
from ..plans.refresh import refresh
from ..session import shared_dir
from ..sources import samples as S
from .base import query

AS_OF = S.AS_OF


def payments(spark, folder):
    return W.stg_payment_events(S.payments(spark, folder))


def alerts(spark, folder):
    return W.stg_fraud_alerts(S.alerts_raw(spark, folder, second=True))


def accounts(spark, folder):
    return W.dim_account(W.int_accounts_latest(payments(spark, folder)))


def facts(spark, folder):
    return W.fct_payments(payments(spark, folder))


def alert_facts(spark, folder):
    return W.fct_fraud_alerts(alerts(spark, folder), accounts(spark, folder))


def rounded(df, *names, digits=6):
    return df.withColumns({n: F.round(n, digits) for n in names})


@query(
    "stg_payment_events",
    "SELECT event_id, payment_id, account_id, CAST(amount AS DOUBLE) AS amount, currency, merchant_id, occurred_at,"
    " CAST(event_date AS VARCHAR) AS event_date FROM sp",
)
def _(spark, folder):
    return payments(spark, folder)


@query(
    "stg_fraud_alerts",
    "SELECT alert_id, user_id, payment_id, score, reasons, rule_id, CAST(alert_date AS VARCHAR) AS alert_date, occurred_at FROM sa",
)
def _(spark, folder):
    return alerts(spark, folder)


_HOURLY = """
  SELECT date_trunc('hour', occurred_at) AS window_start, date_trunc('hour', occurred_at) + INTERVAL 1 HOUR AS window_end,
    CAST(CAST(occurred_at AS DATE) AS VARCHAR) AS metric_date, currency, count(*) AS payment_count,
    CAST(sum(amount) AS DOUBLE) AS total_amount FROM pay GROUP BY 1,2,3,4"""


@query("stg_payment_metrics_hourly", _HOURLY)
def _(spark, folder):
    from ..operators.monitoring import hourly_metrics

    return W.stg_payment_metrics_hourly(hourly_metrics(S.payments(spark, folder)))


@query(
    "stg_saga_events",
    "SELECT saga_id, saga_type, event_type, status, step_name, payment_id, attempt, CAST(event_date AS VARCHAR) AS event_date, occurred_at FROM sev",
)
def _(spark, folder):
    return W.stg_saga_events(S.saga_events(spark, folder))


@query(
    "int_accounts_latest",
    "SELECT account_id, min(occurred_at) AS first_seen_at, max(occurred_at) AS last_seen_at, count(*) AS payment_count FROM sp GROUP BY 1",
)
def _(spark, folder):
    return W.int_accounts_latest(payments(spark, folder))


@query("int_currencies", "SELECT currency, count(*) AS payment_count FROM sp GROUP BY 1")
def _(spark, folder):
    return W.int_currencies(payments(spark, folder))


@query(
    "int_merchants_latest",
    "SELECT merchant_id, min(occurred_at) AS first_seen_at, max(occurred_at) AS last_seen_at, count(*) AS payment_count,"
    " CAST(sum(amount) AS DOUBLE) AS total_amount FROM sp GROUP BY 1",
)
def _(spark, folder):
    return W.int_merchants_latest(payments(spark, folder))


@query(
    "int_rules_latest",
    "SELECT rule_id, min(occurred_at) AS first_seen_at, max(occurred_at) AS last_seen_at, count(*) AS alert_count FROM sa GROUP BY 1",
)
def _(spark, folder):
    return W.int_rules_latest(alerts(spark, folder))


@query(
    "int_payments_with_alerts",
    """SELECT p.event_id, p.payment_id, p.account_id, CAST(p.amount AS DOUBLE) AS amount, p.currency, p.merchant_id, p.occurred_at,
      CAST(p.event_date AS VARCHAR) AS event_date, a.alert_id, a.score AS fraud_score, a.rule_id, coalesce(a.reasons,'') AS fraud_reasons
    FROM sp p LEFT JOIN sa a ON p.payment_id=a.payment_id""",
)
def _(spark, folder):
    return W.int_payments_with_alerts(payments(spark, folder), alerts(spark, folder))


# Sample scores stay below the high-risk limit, so they are doubled here.
_ACTIVITY = """
  SELECT p.account_id, max(p.occurred_at) AS last_payment_at, count(*) AS payment_count, CAST(sum(p.amount) AS DOUBLE) AS total_amount,
    count(*) FILTER (a.s >= 0.8e0) AS high_risk_payment_count
  FROM sp p LEFT JOIN (SELECT payment_id, max(score*2) AS s FROM sa GROUP BY 1) a ON p.payment_id=a.payment_id GROUP BY 1"""


def activity(spark, folder):
    raised = alerts(spark, folder).withColumn("score", F.col("score") * 2)
    return W.int_customer_activity(payments(spark, folder), raised)


@query("int_customer_activity", _ACTIVITY)
def _(spark, folder):
    return activity(spark, folder)


@query(
    "mart_customer_risk_rfm",
    f"""SELECT account_id, date_diff('day', last_payment_at, TIMESTAMP '{AS_OF}') AS recency_days, payment_count AS frequency,
      total_amount AS monetary, high_risk_payment_count,
      CASE WHEN high_risk_payment_count>=3 THEN 'HIGH' WHEN high_risk_payment_count>=1 THEN 'MEDIUM' ELSE 'LOW' END AS risk_segment
    FROM ({_ACTIVITY})""",
)
def _(spark, folder):
    return W.mart_customer_risk_rfm(activity(spark, folder), literal_time(AS_OF))


@query(
    "dim_account",
    "SELECT md5(account_id) AS account_sk, account_id, min(occurred_at) AS first_seen_at, max(occurred_at) AS last_seen_at,"
    " count(*) AS payment_count FROM sp GROUP BY account_id",
)
def _(spark, folder):
    return accounts(spark, folder)


@query(
    "dim_merchant",
    "SELECT md5(merchant_id) AS merchant_sk, merchant_id, min(occurred_at) AS first_seen_at, max(occurred_at) AS last_seen_at,"
    " count(*) AS payment_count, CAST(sum(amount) AS DOUBLE) AS total_amount, TIMESTAMP '1970-01-01' AS valid_from,"
    " TIMESTAMP '2099-12-31 23:59:59' AS valid_to, 1 AS is_current FROM sp GROUP BY merchant_id",
)
def _(spark, folder):
    return W.dim_merchant(W.int_merchants_latest(payments(spark, folder)))


@query("dim_currency", "SELECT DISTINCT md5(currency) AS currency_sk, currency AS currency_code FROM sp")
def _(spark, folder):
    return W.dim_currency(W.int_currencies(payments(spark, folder)))


@query(
    "dim_rule",
    "SELECT md5(rule_id) AS rule_sk, rule_id, min(occurred_at) AS first_seen_at, max(occurred_at) AS last_seen_at,"
    " count(*) AS alert_count FROM sa GROUP BY rule_id",
)
def _(spark, folder):
    return W.dim_rule(W.int_rules_latest(alerts(spark, folder)))


_FACTS = """
  SELECT md5(event_id) AS payment_sk, event_id, payment_id, account_id, merchant_id, currency, CAST(amount AS DOUBLE) AS amount,
    occurred_at, CAST(event_date AS VARCHAR) AS event_date, md5(account_id) AS account_sk, md5(merchant_id) AS merchant_sk,
    md5(currency) AS currency_sk FROM sp"""


@query("fct_payments", _FACTS)
def _(spark, folder):
    return facts(spark, folder)


@query(
    "fct_payments_from_dims",
    """SELECT f.* REPLACE (CASE WHEN m.merchant_id IS NULL THEN NULL ELSE merchant_sk END AS merchant_sk) FROM (""" + _FACTS + """) f
    JOIN (SELECT DISTINCT account_id FROM sp WHERE event_date < DATE '2024-01-15') a USING (account_id)
    LEFT JOIN (SELECT DISTINCT merchant_id FROM sp WHERE NOT contains(merchant_id,':foreign')) m ON f.merchant_id=m.merchant_id""",
)
def _(spark, folder):
    """Dimension snapshots that lack some keys: later accounts and foreign merchants."""
    staged = payments(spark, folder)
    early = staged.filter(F.col("event_date") < F.lit("2024-01-15").cast("date"))
    local = staged.filter(~F.col("merchant_id").contains(":foreign"))
    return W.fct_payments_from(
        staged,
        W.dim_account(W.int_accounts_latest(early)),
        W.dim_merchant(W.int_merchants_latest(local)),
        W.dim_currency(W.int_currencies(staged)),
    )


@query(
    "fct_fraud_alerts",
    """SELECT md5(alert_id) AS alert_sk, alert_id, user_id, payment_id, rule_id, score, reasons, CAST(alert_date AS VARCHAR) AS alert_date,
      occurred_at, md5(user_id) AS account_sk, md5(rule_id) AS rule_sk FROM sa""",
)
def _(spark, folder):
    return alert_facts(spark, folder)


_REVENUE = """
  SELECT CAST(event_date AS VARCHAR) AS revenue_date, currency, count(*) AS payment_count, CAST(sum(amount) AS DOUBLE) AS total_revenue,
    CAST(sum(amount) AS DOUBLE)/count(amount) AS avg_payment_amount FROM sp GROUP BY 1,2"""


@query("mart_daily_revenue", f"SELECT * REPLACE (round(avg_payment_amount,6) AS avg_payment_amount) FROM ({_REVENUE}) ORDER BY 1,2")
def _(spark, folder):
    return rounded(W.mart_daily_revenue(facts(spark, folder)), "avg_payment_amount")


_RISK = """
  SELECT CAST(alert_date AS VARCHAR) AS report_date, count(*) AS alert_count, round(avg(score),6) AS avg_fraud_score, max(score) AS max_fraud_score,
    count(DISTINCT user_id) AS affected_users, count(DISTINCT rule_id) AS triggered_rules FROM sa GROUP BY 1"""


@query("mart_daily_risk_report", _RISK + " ORDER BY 1")
def _(spark, folder):
    return rounded(W.mart_daily_risk_report(alert_facts(spark, folder)), "avg_fraud_score")


_AML = """
  SELECT account_id, CAST(event_date AS VARCHAR) AS event_date, count(*) AS payment_count, CAST(sum(amount) AS DOUBLE) AS daily_total,
    CAST(max(amount) AS DOUBLE) AS max_single_amount
  FROM sp WHERE amount<9900 GROUP BY 1,2 HAVING count(*)>=3 AND sum(amount)>=9900"""


@query("mart_aml_structuring_patterns", _AML)
def _(spark, folder):
    return W.mart_aml_structuring_patterns(facts(spark, folder))


_MERCHANT = """
  SELECT p.merchant_id, count(*) AS payment_count, CAST(sum(p.amount) AS DOUBLE) AS total_amount, count(a.alert_id) AS alert_count,
    round(avg(a.score),6) AS avg_fraud_score, max(a.score) AS max_fraud_score
  FROM sp p LEFT JOIN sa a ON p.payment_id=a.payment_id GROUP BY 1"""


def merchant_mart(spark, folder):
    return W.mart_merchant_risk_profile(facts(spark, folder), alert_facts(spark, folder))


@query("mart_merchant_risk_profile", _MERCHANT)
def _(spark, folder):
    return rounded(merchant_mart(spark, folder), "avg_fraud_score")


_LATENCY = """
  SELECT saga_id, started_at, completed_at, date_diff('second', started_at, completed_at) AS latency_seconds
  FROM (SELECT saga_id, min(occurred_at) AS started_at FROM sev WHERE event_type='SAGA_STARTED' GROUP BY 1) s
  JOIN (SELECT saga_id, min(occurred_at) AS completed_at FROM sev WHERE event_type='SAGA_COMPLETED' GROUP BY 1) c USING (saga_id)"""


def latency_mart(spark, folder):
    return W.mart_settlement_latency(W.stg_saga_events(S.saga_events(spark, folder)))


@query("mart_settlement_latency", _LATENCY)
def _(spark, folder):
    return latency_mart(spark, folder)


# Charts


@query("chart_revenue", f"SELECT revenue_date, sum(total_revenue) AS sum_total_revenue FROM ({_REVENUE}) GROUP BY 1 ORDER BY 1")
def _(spark, folder):
    return V.chart(W.mart_daily_revenue(facts(spark, folder)), ["revenue_date"], F.sum("total_revenue"), "sum_total_revenue")


@query("chart_risk", f"SELECT report_date, CAST(sum(alert_count) AS BIGINT) AS sum_alert_count FROM ({_RISK}) GROUP BY 1 ORDER BY 1")
def _(spark, folder):
    return V.chart(W.mart_daily_risk_report(alert_facts(spark, folder)), ["report_date"], F.sum("alert_count"), "sum_alert_count")


@query(
    "chart_rfm",
    f"""SELECT CASE WHEN high_risk_payment_count>=3 THEN 'HIGH' WHEN high_risk_payment_count>=1 THEN 'MEDIUM' ELSE 'LOW' END AS risk_segment,
    count(*) AS customers FROM ({_ACTIVITY}) GROUP BY 1""",
)
def _(spark, folder):
    mart = W.mart_customer_risk_rfm(activity(spark, folder), literal_time(AS_OF))
    return V.chart(mart, ["risk_segment"], F.count(F.lit(1)), "customers")


@query(
    "chart_merchant",
    f"SELECT merchant_id, CAST(sum(alert_count) AS BIGINT) AS sum_alert_count FROM ({_MERCHANT}) GROUP BY 1 ORDER BY 1",
)
def _(spark, folder):
    return V.chart(merchant_mart(spark, folder), ["merchant_id"], F.sum("alert_count"), "sum_alert_count")


@query("chart_latency_avg", f"SELECT round(avg(latency_seconds),6) AS avg_latency FROM ({_LATENCY})")
def _(spark, folder):
    return latency_mart(spark, folder).agg(F.round(F.avg("latency_seconds"), 6).alias("avg_latency"))


@query(
    "chart_aml_total",
    "SELECT event_date, CAST(sum(t) AS DOUBLE) AS sum_daily_total FROM (SELECT account_id, CAST(event_date AS VARCHAR) AS event_date,"
    " sum(amount) AS t FROM sp WHERE amount<9900 GROUP BY 1,2 HAVING count(*)>=3 AND sum(amount)>=9900) GROUP BY 1 ORDER BY 1",
)
def _(spark, folder):
    mart = W.mart_aml_structuring_patterns(facts(spark, folder))
    return V.chart(mart, ["event_date"], F.sum("daily_total"), "sum_daily_total")


@query("chart_aml_top", f"SELECT * FROM ({_AML}) ORDER BY daily_total DESC, account_id, event_date LIMIT 50")
def _(spark, folder):
    return V.top_rows(W.mart_aml_structuring_patterns(facts(spark, folder)), "daily_total", "account_id", "event_date")


@query(
    "latency_histogram",
    f"""WITH l AS ({_LATENCY}), b AS (SELECT CAST(min(latency_seconds) AS DOUBLE) AS lo, CAST(max(latency_seconds) AS DOUBLE) AS hi FROM l),
    c AS (SELECT CAST(least(floor((latency_seconds-lo)/((hi-lo)/25)),24) AS INT) AS bin, count(*) AS n FROM l, b GROUP BY 1)
    SELECT CAST(s.bin AS INT) AS bin, round(lo + s.bin*((hi-lo)/25),6) AS bin_start, round(lo + (s.bin+1)*((hi-lo)/25),6) AS bin_end, coalesce(n,0) AS rows
    FROM range(25) s(bin) CROSS JOIN b LEFT JOIN c ON c.bin=s.bin""",
)
def _(spark, folder):
    return rounded(V.histogram(latency_mart(spark, folder), "latency_seconds"), "bin_start", "bin_end")


@query(
    "chart_pivot",
    f"""SELECT revenue_date, max(r) FILTER (currency='USD') AS revenue_usd, max(r) FILTER (currency='EUR') AS revenue_eur,
      max(r) FILTER (currency='GBP') AS revenue_gbp
    FROM (SELECT revenue_date, currency, sum(total_revenue) AS r FROM ({_REVENUE}) GROUP BY 1,2) GROUP BY 1""",
)
def _(spark, folder):
    mart = W.mart_daily_revenue(facts(spark, folder))
    return V.chart_pivot(mart, "revenue_date", "currency", F.sum("total_revenue"), ["USD", "EUR", "GBP"], "revenue")


@query(
    "refresh_tables",
    f"""WITH kept AS (SELECT * FROM sa WHERE alert_date + 90 > DATE '{AS_OF[:10]}')
    SELECT 'stg_payment_events' AS table_name, count(*) AS rows FROM sp UNION ALL SELECT 'fct_payments', count(*) FROM sp
    UNION ALL SELECT 'stg_fraud_alerts', count(*) FROM kept UNION ALL SELECT 'fct_fraud_alerts', count(*) FROM kept
    UNION ALL SELECT 'dim_account', count(DISTINCT account_id) FROM sp UNION ALL SELECT 'dim_merchant', count(DISTINCT merchant_id) FROM sp
    UNION ALL SELECT 'dim_currency', count(DISTINCT currency) FROM sp UNION ALL SELECT 'dim_rule', count(DISTINCT rule_id) FROM kept
    UNION ALL SELECT 'mart_daily_revenue', count(*) FROM (SELECT DISTINCT event_date, currency FROM sp)
    UNION ALL SELECT 'mart_daily_risk_report', count(DISTINCT alert_date) FROM kept
    UNION ALL SELECT 'mart_aml_structuring_patterns', count(*) FROM (SELECT 1 FROM sp WHERE amount<9900 GROUP BY account_id, event_date HAVING count(*)>=3 AND sum(amount)>=9900)
    UNION ALL SELECT 'mart_customer_risk_rfm', count(DISTINCT account_id) FROM sp UNION ALL SELECT 'mart_merchant_risk_profile', count(DISTINCT merchant_id) FROM sp
    UNION ALL SELECT 'mart_settlement_latency', 0 UNION ALL SELECT 'stg_saga_events', 0
    UNION ALL SELECT 'stg_payment_metrics_hourly', count(*) FROM (SELECT DISTINCT date_trunc('hour', occurred_at), currency FROM pay)""",
)
def _(spark, folder):
    """Rows of every table of a refresh whose raw payments are landed twice; all sample lifecycles have expired."""
    once = S.payments(spark, folder).withColumnRenamed("seq", "offset")
    raw = {
        "payment_events": once.unionByName(once.withColumn("offset", F.col("offset") - 10**6)),
        "fraud_alerts": S.alerts_raw(spark, folder, second=True),
        "payment_metrics_hourly": hourly_metrics(S.payments(spark, folder)),
        "saga_events": S.saga_events(spark, folder),
    }
    tables = refresh(spark, raw, shared_dir(spark, "warehouse"), literal_time(AS_OF))
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
