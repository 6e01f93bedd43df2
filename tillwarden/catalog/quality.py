"""Data-quality checks, run on tables with known faults so that each has something to find."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import literal_time
from ..operators import ledger as L
from ..operators import quality as Q
from ..operators import warehouse as W
from ..plans.refresh import check_report
from ..sources import samples as S
from ..sources.tables import read_table
from .base import query
from .ledger import unique_arrivals
from .warehouse import activity, alerts, facts, payments


@query("dq_not_null", "SELECT event_id, payment_id FROM sp WHERE merchant_id='unknown'")
def _(spark, folder):
    """Merchants before staging: an empty one counts as missing."""
    gaps = payments(spark, folder).withColumn("merchant_id", F.nullif("merchant_id", F.lit("unknown")))
    return Q.not_null(gaps, "merchant_id").select("event_id", "payment_id")


@query("dq_unique", "SELECT event_id, count(*) AS rows FROM arr GROUP BY 1 HAVING count(*)>1")
def _(spark, folder):
    return Q.unique(S.payment_arrivals(spark, folder), "event_id")


@query(
    "dq_relationships",
    "SELECT account_id, count(*) AS rows FROM pay WHERE account_id NOT IN (SELECT user_id FROM prof) GROUP BY 1",
)
def _(spark, folder):
    """Accounts without a risk profile."""
    return Q.relationships(S.payments(spark, folder), "account_id", S.profiles(spark, folder), "user_id")


@query(
    "dq_accepted_values",
    "SELECT currency, count(*) AS rows FROM sp WHERE currency NOT IN ('USD','EUR') GROUP BY 1",
)
def _(spark, folder):
    return Q.accepted_values(payments(spark, folder), "currency", ["USD", "EUR"])


@query(
    "dq_accepted_segments",
    "SELECT 'EXTREME' AS risk_segment, count(*) AS rows FROM (SELECT DISTINCT account_id FROM sp WHERE account_id LIKE '%3') HAVING count(*)>0",
)
def _(spark, folder):
    """Customers whose account ends in 3 have a segment that is not accepted."""
    mart = W.mart_customer_risk_rfm(activity(spark, folder), literal_time(S.AS_OF))
    odd = F.when(F.col("account_id").endswith("3"), "EXTREME").otherwise(F.col("risk_segment"))
    return Q.accepted_values(mart.withColumn("risk_segment", odd), "risk_segment", ["LOW", "MEDIUM", "HIGH"])


@query("dq_positive_amount", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal<0")
def _(spark, folder):
    return Q.positive_amount(read_table(spark, folder, "customer"), "c_acctbal").select("c_custkey", "c_acctbal")


@query("dq_score_range", "SELECT alert_id, score*3 AS score FROM sa WHERE score*3>1")
def _(spark, folder):
    tripled = alerts(spark, folder).withColumn("score", F.col("score") * 3)
    return Q.score_in_range(tripled, "score").select("alert_id", "score")


@query(
    "dq_freshness",
    "SELECT count(*) AS rows, CAST(CAST(max(occurred_at) AS DATE) AS VARCHAR) AS newest_date FROM pay HAVING CAST(max(occurred_at) AS DATE) < DATE '2024-02-09'",
)
def _(spark, folder):
    return Q.freshness(S.payments(spark, folder), "occurred_at", literal_time("2024-02-10 00:00:00"))


@query(
    "dq_balance_reconcile",
    """SELECT account_id, currency, CAST(sum(amount)+1 AS DOUBLE) AS balance, CAST(sum(amount) AS DOUBLE) AS delta_sum, 1e0 AS difference
    FROM uniq WHERE account_id LIKE '%7' GROUP BY 1,2""",
)
def _(spark, folder):
    """Balances of accounts that end in 7 are one unit off."""
    arrived = unique_arrivals(spark, folder)
    balances = L.account_balance(arrived)
    off = F.when(F.col("account_id").endswith("7"), F.col("balance") + 1).otherwise(F.col("balance"))
    return Q.balance_reconcile(balances.withColumn("balance", off), L.balance_events(arrived))


@query("dq_event_version", "SELECT aggregate_id, version, count(*) AS rows FROM est GROUP BY 1,2 HAVING count(*)>1")
def _(spark, folder):
    return Q.event_version(S.event_store(spark, folder))


@query(
    "dq_fact_keys",
    "SELECT md5(merchant_id) AS merchant_sk, count(*) AS rows FROM sp WHERE merchant_id LIKE 'm-1%' GROUP BY 1",
)
def _(spark, folder):
    """Merchant keys of the facts that are not in a dimension without the merchants m-1*."""
    merchants = W.dim_merchant(W.int_merchants_latest(payments(spark, folder))).filter(~F.col("merchant_id").startswith("m-1"))
    return Q.relationships(facts(spark, folder), "merchant_sk", merchants, "merchant_sk")


_REPORT = """
  SELECT unnest(['stg_payment_events.event_id.not_null','stg_payment_events.currency.not_null','stg_payment_events.amount.positive_amount',
    'stg_fraud_alerts.alert_id.not_null','stg_fraud_alerts.score.score_range','stg_payment_events.event_id.unique','stg_fraud_alerts.alert_id.unique',
    'dim_account.account_sk.not_null','dim_account.account_id.not_null','dim_account.account_sk.unique','dim_account.account_id.unique',
    'fct_payments.payment_sk.not_null','fct_payments.account_sk.not_null','fct_payments.currency_sk.not_null','fct_payments.amount.positive_amount',
    'fct_payments.payment_sk.unique','fct_payments.account_sk.relationships']) AS check_name, CAST(0 AS BIGINT) AS violations"""


@query(
    "dq_report",
    f"""SELECT check_name, CASE WHEN check_name='stg_fraud_alerts.score.score_range' THEN (SELECT count(*) FROM sa WHERE score*2>1)
      WHEN check_name='fct_payments.account_sk.relationships' THEN (SELECT count(DISTINCT account_id) FROM sp WHERE account_id LIKE '%3')
      ELSE violations END AS violations FROM ({_REPORT})""",
)
def _(spark, folder):
    """All checks of four tables: some scores are too high, and some accounts lack a dimension row."""
    raised = alerts(spark, folder).withColumn("score", F.col("score") * 2)
    known = W.dim_account(W.int_accounts_latest(payments(spark, folder))).filter(~F.col("account_id").endswith("3"))
    return check_report(
        {
            "stg_payment_events": payments(spark, folder),
            "stg_fraud_alerts": raised,
            "dim_account": known,
            "fct_payments": facts(spark, folder),
        }
    )
