"""Event store, idempotency and balances."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import literal_time
from ..operators import landing as A
from ..operators import ledger as L
from ..operators import monitoring as M
from ..sources import samples as S
from ..sources.tables import read_table
from .base import query

AS_OF = S.AS_OF


def unique_arrivals(spark, folder):
    return A.dedup_first(S.payment_arrivals(spark, folder), ["event_id"])


@query(
    "balance_events",
    "SELECT source_event_id, account_id, currency, CAST(delta AS DOUBLE) AS delta, occurred_at, aggregate_id, arrival, CAST(balance_after AS DOUBLE) AS balance_after FROM bal",
)
def _(spark, folder):
    return L.balance_events(unique_arrivals(spark, folder))


@query(
    "account_balance",
    "SELECT account_id, currency, CAST(balance AS DOUBLE) AS balance, last_occurred_at, last_source_event_id FROM acct",
)
def _(spark, folder):
    return L.account_balance(unique_arrivals(spark, folder))


def _probes(spark, folder):
    """One probe per event of every account, an hour and a half before it, and one per unknown account."""
    p = S.payments(spark, folder)
    unknown = F.when(F.col("seq") % 10 == 0, F.concat("account_id", F.lit("-x"))).otherwise(F.col("account_id"))
    return p.select(
        F.col("seq").alias("probe_id"),
        unknown.alias("account_id"),
        "currency",
        (F.col("occurred_at") - F.expr("INTERVAL 90 MINUTES")).alias("at"),
    )


@query(
    "balance_asof",
    """WITH p AS (SELECT seq AS probe_id, CASE WHEN seq%10=0 THEN account_id||'-x' ELSE account_id END AS account_id, currency,
        occurred_at - INTERVAL 90 MINUTE AS "at" FROM pay),
      u AS (SELECT account_id, currency, occurred_at AS t, 0 AS f, arrival AS id, balance_after, occurred_at, NULL AS probe_id, NULL::TIMESTAMP AS "at" FROM bal
        UNION ALL SELECT account_id, currency, "at", 1, probe_id, NULL, NULL, probe_id, "at" FROM p),
      f AS (SELECT probe_id, account_id, currency, "at", f, last_value(balance_after IGNORE NULLS) OVER w AS balance, last_value(occurred_at IGNORE NULLS) OVER w AS o
        FROM u WINDOW w AS (PARTITION BY account_id, currency ORDER BY t, f, id ROWS UNBOUNDED PRECEDING))
      SELECT probe_id, account_id, currency, "at", CAST(coalesce(balance,0) AS DOUBLE) AS balance, coalesce(o, "at") AS as_of FROM f WHERE f=1""",
)
def _(spark, folder):
    return L.balance_asof(_probes(spark, folder), L.balance_events(unique_arrivals(spark, folder)))


@query(
    "balance_current",
    """SELECT p.account_id, p.currency, CAST(coalesce(balance,0) AS DOUBLE) AS balance, last_occurred_at AS as_of
    FROM (SELECT 'acc-'||c_custkey AS account_id, c AS currency FROM customer, (VALUES ('USD'),('EUR'),('GBP')) v(c)) p
    LEFT JOIN acct a USING (account_id, currency)""",
)
def _(spark, folder):
    probes = read_table(spark, folder, "customer").select(
        F.concat(F.lit("acc-"), "c_custkey").alias("account_id"),
        F.explode(F.array(F.lit("USD"), F.lit("EUR"), F.lit("GBP"))).alias("currency"),
    )
    return L.balance_current(probes, L.account_balance(unique_arrivals(spark, folder)))


@query(
    "event_versions",
    """SELECT id, aggregate_id, CAST(v + CASE WHEN settled THEN 2 ELSE 1 END AS INT) AS version FROM (
      SELECT id, aggregate_id, row_number() OVER (PARTITION BY aggregate_id ORDER BY occurred_at, id) AS v FROM est)
      JOIN (SELECT 'pay-'||o_orderkey AS aggregate_id, path='C' AS settled FROM ord) USING (aggregate_id)""",
)
def _(spark, folder):
    """The same events appended once more to the stored ones."""
    stored = S.event_store(spark, folder)
    return L.event_versions(stored.drop("version"), stored).select("id", "aggregate_id", "version")


@query("aggregate_versions", "SELECT aggregate_id, max(version) AS version FROM est GROUP BY 1")
def _(spark, folder):
    return L.aggregate_versions(S.event_store(spark, folder))


@query("version_conflicts", "SELECT aggregate_id, version, count(*) AS events FROM est GROUP BY 1,2 HAVING count(*)>1")
def _(spark, folder):
    return L.version_conflicts(S.event_store(spark, folder))


@query(
    "payment_state",
    """SELECT aggregate_id, arg_max(event_type, version) AS state, max(version) AS version,
      min(occurred_at) FILTER (event_type='PaymentInitiatedV1') AS initiated_at, min(occurred_at) FILTER (event_type='PaymentSettledV1') AS settled_at
    FROM est GROUP BY 1""",
)
def _(spark, folder):
    return L.payment_state(S.event_store(spark, folder))


def _commands(spark, folder):
    """Ledger commands of completed lifecycles, every eighth delivered twice."""
    done = S.orders(spark, folder).filter(F.col("path") == "C")
    copies = F.when(F.col("o_orderkey") % 8 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return done.withColumn("copy", F.explode(copies)).select(
        F.concat(F.lit("saga-"), "o_orderkey").alias("saga_id"),
        F.lit("LEDGER_APPLY").alias("step_name"),
        (F.col("o_orderkey") * 10 + F.col("copy")).alias("seq"),
        F.concat(F.lit("pay-"), "o_orderkey").alias("payment_id"),
        F.concat(F.lit("acc-"), "o_custkey").alias("account_id"),
        (F.col("o_totalprice") / 8).cast("decimal(19,4)").alias("amount"),
        F.lit("USD").alias("currency"),
        F.col("start").alias("occurred_at"),
    )


@query(
    "settled_events",
    """SELECT md5(saga_id||'|LEDGER_APPLY') AS event_id, 'pay-'||o_orderkey AS aggregate_id, 'PaymentSettledV1' AS event_type,
      CAST(2 + row_number() OVER (PARTITION BY o_orderkey ORDER BY saga_id) AS INT) AS version, 'acc-'||o_custkey AS account_id,
      CAST(round(CAST(o_totalprice/8 AS DECIMAL(19,4)),2) AS DOUBLE) AS amount, 'USD' AS currency, start AS occurred_at
    FROM (SELECT *, 'saga-'||o_orderkey||again AS saga_id FROM ord, (VALUES (''),('-again')) a(again) WHERE path='C' AND (again='' OR o_orderkey%5=0))""",
)
def _(spark, folder):
    """Payments with two sagas and with stored versions; both count on from there."""
    commands = _commands(spark, folder)
    again = commands.filter(F.col("payment_id").rlike("[05]$")).withColumns(
        {"saga_id": F.concat("saga_id", F.lit("-again")), "seq": F.col("seq") + 5}
    )
    return L.settled_events(commands.unionByName(again), S.event_store(spark, folder))


@query(
    "processed_commands",
    """SELECT 'saga-'||o_orderkey AS saga_id, 'LEDGER_APPLY' AS step_name, o_orderkey*10+copy AS seq,
      CASE WHEN o_orderkey%3=0 OR copy=1 THEN 'replayed' ELSE 'executed' END AS outcome,
      CASE WHEN o_orderkey%3=0 THEN 'stored-'||o_orderkey ELSE 'reply-'||(o_orderkey*10) END AS reply_payload
    FROM ord, (VALUES (0),(1)) c(copy) WHERE path='C' AND (copy=0 OR o_orderkey%8=0)""",
)
def _(spark, folder):
    commands = _commands(spark, folder).withColumn("reply_payload", F.concat(F.lit("reply-"), "seq"))
    stored = S.orders(spark, folder).filter(F.col("o_orderkey") % 3 == 0).select(
        F.concat(F.lit("saga-"), "o_orderkey").alias("saga_id"),
        F.lit("LEDGER_APPLY").alias("step_name"),
        F.concat(F.lit("stored-"), "o_orderkey").alias("reply_payload"),
    )
    return L.processed_commands(commands, stored)


_OUTCOME = "CASE WHEN rn=1 THEN 'created' WHEN body=first_body THEN 'idempotent_hit' ELSE 'failed' END"


@query(
    "idempotency_outcome",
    f"SELECT idempotency_key, sha256(idempotency_key) AS key_hash, body, requested_at, account_id, {_OUTCOME} AS outcome FROM req",
)
def _(spark, folder):
    result = L.idempotency_outcome(S.requests(spark, folder))
    return result.select("idempotency_key", "key_hash", "body", "requested_at", "account_id", "outcome")


@query(
    "idempotency_equal_arrivals",
    """WITH r AS (SELECT idempotency_key, body||CASE WHEN c=1 THEN 'x' ELSE '' END AS body, requested_at FROM req, (VALUES (0),(1)) v(c) WHERE c=0 OR body LIKE '1%')
    SELECT idempotency_key, body, requested_at, CASE WHEN row_number() OVER w = 1 THEN 'created' WHEN body = first_value(body) OVER w THEN 'idempotent_hit' ELSE 'failed' END AS outcome
    FROM r WINDOW w AS (PARTITION BY idempotency_key ORDER BY requested_at, sha256(body))""",
)
def _(spark, folder):
    """Requests that arrive at once, some with another body: one of each key is created."""
    copies = F.when(F.col("body").startswith("1"), F.array(F.lit(""), F.lit("x"))).otherwise(F.array(F.lit("")))
    requests = S.requests(spark, folder).withColumn("arrival", F.col("requested_at")).withColumn("copy", F.explode(copies))
    result = L.idempotency_outcome(requests.withColumn("body", F.concat("body", "copy")))
    return result.select("idempotency_key", "body", "requested_at", "outcome")


@query(
    "idempotency_records",
    "SELECT sha256(idempotency_key) AS key_hash, sha256(body) AS request_hash, requested_at AS created_at, requested_at + INTERVAL 1 DAY AS expires_at FROM req WHERE rn=1",
)
def _(spark, folder):
    return L.idempotency_records(S.requests(spark, folder))


def _outbox(spark, folder):
    """Start messages spread over the day of their order."""
    return S.orders(spark, folder).select(
        F.concat(F.lit("saga-"), "o_orderkey").alias("saga_id"),
        F.concat(F.lit("pay-"), "o_orderkey").alias("payment_id"),
        F.concat(F.lit("acc-"), "o_custkey").alias("account_id"),
        F.col("o_totalprice").cast("decimal(19,4)").alias("amount"),
        F.lit("USD").alias("currency"),
        F.lit(None).cast("string").alias("merchant_id"),
        F.timestamp_seconds(F.unix_seconds("start") + F.col("o_orderkey") * 37 % 86_400).alias("occurred_at"),
    )


_OUTBOX = "SELECT *, start + to_seconds(o_orderkey*37%86400) AS created_at FROM ord"


@query(
    "outbox_messages",
    f"""SELECT 'saga-'||o_orderkey AS partitioning_key, 'SagaStart:PaymentSaga' AS type, created_at,
      '{{"sagaId":"saga-'||o_orderkey||'","sagaType":"PaymentSaga","paymentId":"pay-'||o_orderkey||'","accountId":"acc-'||o_custkey||
      '","amount":'||CAST(o_totalprice AS DECIMAL(19,2))||',"currency":"USD"}}' AS payload FROM ({_OUTBOX})""",
)
def _(spark, folder):
    return L.outbox_messages(_outbox(spark, folder))


@query(
    "projection_lag",
    f"SELECT greatest(0e0, (epoch_ms(TIMESTAMP '{AS_OF}') - epoch_ms(max(last_occurred_at)))/1000) AS lag_seconds FROM acct",
)
def _(spark, folder):
    return M.projection_lag(L.account_balance(unique_arrivals(spark, folder)), literal_time(AS_OF))


@query(
    "outbox_lag",
    f"SELECT greatest(0e0, (epoch_ms(TIMESTAMP '{S.ORDERS_AS_OF}') - epoch_ms(max(created_at)))/1000) AS lag_seconds FROM ({_OUTBOX})",
)
def _(spark, folder):
    return M.outbox_lag(L.outbox_messages(_outbox(spark, folder)), literal_time(S.ORDERS_AS_OF))


_LAG_SECONDS, _HOLD = 30, 5


@query(
    "alarm_outbox_lag",
    f"""WITH o AS ({_OUTBOX}), q AS (SELECT DISTINCT CAST(ceil(epoch(created_at)/60) AS BIGINT) AS m FROM o
        WHERE ceil(epoch(created_at)/60)*60 - epoch(created_at) <= {_LAG_SECONDS}
        UNION SELECT CAST(ceil(min(epoch(created_at))/60) AS BIGINT)-1 FROM o),
      e AS (SELECT epoch(TIMESTAMP '{S.ORDERS_AS_OF}')/60 + 1 AS m),
      s AS (SELECT q.m+1 AS f, CAST(coalesce(lead(q.m) OVER (ORDER BY q.m), e.m) AS BIGINT)-1 AS t FROM q, e)
    SELECT make_timestamp(f*60000000) AS pending_since, make_timestamp((f+{_HOLD})*60000000) AS fired_at, make_timestamp(t*60000000) AS last_true_at
    FROM s WHERE t-f >= {_HOLD}""",
)
def _(spark, folder):
    return M.alarm_outbox_lag(L.outbox_messages(_outbox(spark, folder)), literal_time(S.ORDERS_AS_OF))


def _rate_sql(source, keys, seconds, step=60):
    k = "".join(f"{x}, " for x in keys)
    return f"""
      SELECT {k}make_timestamp((slot+i)*{step}*1000000) AS "at", CAST(sum(n) AS BIGINT) AS events, sum(n)/{seconds} AS per_second
      FROM (SELECT {k}CAST(floor(epoch(t)/{step}) AS BIGINT) AS slot, count(*) AS n FROM ({source}) GROUP BY ALL), (SELECT unnest(range(1,{seconds // step}+1)) AS i)
      GROUP BY ALL"""


@query("payment_rate", f"SELECT result, \"at\", events, round(per_second,9) AS per_second FROM ({_rate_sql(f'SELECT {_OUTCOME} AS result, requested_at AS t FROM req', ['result'], 60, 15)})")
def _(spark, folder):
    done = L.idempotency_outcome(S.requests(spark, folder)).withColumnRenamed("outcome", "result")
    return M.rate(done, "requested_at", ["result"], 60, 15).withColumn("per_second", F.round("per_second", 9))


@query("dlt_rate", f"SELECT \"at\", events, round(per_second,9) AS per_second FROM ({_rate_sql('SELECT occurred_at AS t FROM raw WHERE k%10 IN (3,7)', [], 300)})")
def _(spark, folder):
    """Dead letters by the event time that their payment had."""
    bad = S.payments(spark, folder).filter((F.col("k") % 10).isin(3, 7))
    return M.rate(bad, "occurred_at", [], 300).withColumn("per_second", F.round("per_second", 9))


@query(
    "alert_rate",
    "SELECT severity, \"at\", events, round(per_second,9) AS per_second FROM ("
    + _rate_sql("SELECT CASE WHEN score>=0.9 THEN 'critical' WHEN score>=0.7 THEN 'high' ELSE 'medium' END AS severity, occurred_at AS t FROM sa", ["severity"], 300)
    + ")",
)
def _(spark, folder):
    from ..functions.columns import severity
    from .warehouse import alerts

    graded = alerts(spark, folder).withColumn("severity", severity("score"))
    return M.rate(graded, "occurred_at", ["severity"], 300).withColumn("per_second", F.round("per_second", 9))


@query(
    "saga_outcome_rate",
    "SELECT outcome, \"at\", events, round(per_second,9) AS per_second FROM ("
    + _rate_sql("SELECT substr(event_type,6) AS outcome, occurred_at AS t FROM sev WHERE event_type IN ('SAGA_COMPLETED','SAGA_FAILED','SAGA_COMPENSATED')", ["outcome"], 300)
    + ")",
)
def _(spark, folder):
    from ..operators.lifecycle import outcome_of

    ended = S.saga_events(spark, folder).withColumn("outcome", outcome_of(F.col("event_type"))).filter(F.col("outcome").isNotNull())
    return M.rate(ended, "occurred_at", ["outcome"], 300).withColumn("per_second", F.round("per_second", 9))


def _alarm_sql(source, threshold):
    return f"""
      WITH r AS ({_rate_sql(source, [], 300)}), p AS (SELECT CAST(epoch("at")/60 AS BIGINT) AS s FROM r WHERE per_second > {threshold}),
      g AS (SELECT s, s - row_number() OVER (ORDER BY s) AS island FROM p)
      SELECT make_timestamp(min(s)*60000000) AS pending_since, make_timestamp((min(s)+5)*60000000) AS fired_at, make_timestamp(max(s)*60000000) AS last_true_at
      FROM g GROUP BY island HAVING max(s)-min(s)>=5"""


_QUIET = 0.003  # the sample data is far quieter than the alarm limits


@query("alarm_high_fraud", _alarm_sql("SELECT occurred_at AS t FROM sa", _QUIET))
def _(spark, folder):
    from .warehouse import alerts

    return M.alarm_high_fraud(alerts(spark, folder), _QUIET)


@query("alarm_compensation", _alarm_sql("SELECT occurred_at AS t FROM sev WHERE event_type='SAGA_COMPENSATED'", _QUIET))
def _(spark, folder):
    return M.alarm_compensation(S.saga_events(spark, folder), _QUIET)


@query(
    "sustained_alerts",
    """WITH m AS (SELECT CAST(floor(epoch(occurred_at)/60) AS BIGINT) AS s, count(*) AS n FROM pay WHERE amount>5000 GROUP BY 1),
      g AS (SELECT s, s - row_number() OVER (ORDER BY s) AS island FROM m)
    SELECT make_timestamp(min(s)*60000000) AS pending_since, make_timestamp((min(s)+1)*60000000) AS fired_at, make_timestamp(max(s)*60000000) AS last_true_at
    FROM g GROUP BY island HAVING max(s)-min(s)>=1""",
)
def _(spark, folder):
    """Minutes with a payment above 5000, held for one minute."""
    high = S.payments(spark, folder).filter(F.col("amount") > 5000).select(F.date_trunc("minute", "occurred_at").alias("at"))
    return M.sustained(high, 60)
