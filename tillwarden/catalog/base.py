"""Registry of named queries with the SQL that checks each of them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import use_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Shared tables of the oracles: the driver's tables shaped into the payment domain.
CTES = {
    "pay": """
      SELECT 'evt-'||event_id AS event_id, 'pay-'||event_id AS payment_id, 'acc-'||user_id AS account_id,
        CAST(round(value*100,2) AS DECIMAL(19,4)) AS amount,
        CASE user_id%3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END AS currency,
        CASE WHEN k<5 THEN '' WHEN event_type='error' THEN 'm-'||(k%20)||':foreign' ELSE 'm-'||(k%20) END AS merchant_id,
        date_trunc('milliseconds', ts) AS occurred_at, epoch_ms(date_trunc('milliseconds', ts)) AS occurred_ms, event_id AS seq, k
      FROM (SELECT *, CAST(regexp_extract(props,'(\\d+)',1) AS INT) AS k FROM events)""",
    "arr": """
      SELECT pay.* , seq*100 + (seq%7)*300 + seq%100 + CAST(shift AS BIGINT) AS arrival
      FROM pay, (VALUES (0), (1000000000000)) s(shift) WHERE shift=0 OR seq%50=0""",
    "uniq": "SELECT * FROM arr QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY arrival)=1",
    "raw": """
      SELECT *, CASE WHEN k%10=3 THEN 'not-json' ELSE
        '{"eventId":"'||event_id||'","paymentId":"'||payment_id||'",'||
        CASE WHEN k%10=7 THEN '' ELSE '"accountId":"'||account_id||'",' END||'"amount":'||
        CASE WHEN k%10=9 THEN '"'||CAST(amount AS VARCHAR)||'"' ELSE CAST(amount AS VARCHAR) END||
        ',"currency":"'||currency||'","merchantId":'||CASE WHEN merchant_id='' THEN '""' ELSE '"'||merchant_id||'"' END||
        ',"occurredAt":"'||strftime(occurred_at,'%Y-%m-%dT%H:%M:%S.%g')||'Z"}' END AS value
      FROM pay""",
    "prof": """
      SELECT 'acc-'||c_custkey AS user_id, least(1e0, greatest(0e0, c_acctbal/10000)) AS baseline_risk
      FROM customer WHERE c_custkey%4<>0""",
    "al": """
      SELECT 'al-'||seq AS alert_id, account_id AS user_id, payment_id,
        (CASE WHEN amount>10000 THEN 0.35e0 ELSE 0e0 END) + (CASE WHEN contains(merchant_id,':foreign') THEN 0.15e0 ELSE 0e0 END) + 0.2e0*0.1e0 AS score,
        concat_ws('|', CASE WHEN amount>10000 THEN 'amount_over_max' END, CASE WHEN contains(merchant_id,':foreign') THEN 'geo_anomaly' END) AS reasons,
        CASE WHEN seq%7=0 THEN '' ELSE 'rule-'||(seq%5) END AS rule_id, CAST(occurred_at AS DATE) AS alert_date, occurred_at, occurred_ms, seq
      FROM pay WHERE amount>10000 OR contains(merchant_id,':foreign')""",
    "al2": "SELECT * FROM al UNION ALL SELECT * REPLACE ('al2-'||seq AS alert_id) FROM al WHERE seq%11=0",
    "sp": """
      SELECT event_id, payment_id, account_id, amount, currency, coalesce(nullif(merchant_id,''),'unknown') AS merchant_id,
        occurred_at, CAST(occurred_at AS DATE) AS event_date FROM pay""",
    "sa": "SELECT * REPLACE (coalesce(nullif(rule_id,''),'unknown') AS rule_id) FROM al2",
    "ord": """
      SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate AS start, o_orderkey%30+1 AS u,
        CASE WHEN o_orderstatus='F' THEN 'C' WHEN o_orderstatus='P' AND CAST(substr(o_orderpriority,1,1) AS INT)<=3 THEN 'K'
             WHEN o_orderstatus='P' THEN 'X' ELSE 'O' END AS path FROM orders""",
    "sev": """
      SELECT 'saga-'||o_orderkey AS saga_id, 'PaymentSaga' AS saga_type, event_type, status, step_name,
        'pay-'||o_orderkey AS payment_id, CAST(attempt AS INT) AS attempt, CAST(start + to_seconds(i*u) AS DATE) AS event_date,
        start + to_seconds(i*u) AS occurred_at, o_orderkey*10+i AS seq
      FROM ord JOIN (VALUES {PATH_EVENTS}) p(path,i,event_type,status,step_name,attempt) USING (path)""",
    "inst": """
      SELECT o_orderkey AS id, 'saga-'||o_orderkey AS saga_id, 'PaymentSaga' AS saga_type, status, current_step,
        '{"paymentId":"pay-'||o_orderkey||'","accountId":"acc-'||o_custkey||'","amount":'||CAST(o_totalprice AS DECIMAL(19,2))||'}' AS payload,
        start AS created_at, start + to_seconds(l*u) AS updated_at, CASE WHEN path<>'O' THEN start + to_seconds(l*u) END AS completed_at
      FROM ord JOIN (VALUES {PATH_ENDS}) p(path,status,current_step,l) USING (path)""",
    "stp": """
      SELECT o_orderkey*4+step_order AS id, o_orderkey AS saga_instance_id, 'saga-'||o_orderkey AS saga_id, step_name,
        CASE step_name WHEN 'LEDGER_APPLY' THEN 'PIVOT' WHEN 'NOTIFY' THEN 'RETRYABLE' ELSE 'COMPENSABLE' END AS step_type,
        CAST(step_order AS INT) AS step_order, status, CASE WHEN status='FAILED' THEN 'declined by '||step_name END AS error_message,
        CAST(retry_count AS INT) AS retry_count, start + to_seconds(i0*u) AS started_at, start + to_seconds(i1*u) AS completed_at
      FROM ord JOIN (VALUES {PATH_STEPS}) p(path,step_name,step_order,status,retry_count,i0,i1) USING (path)""",
    "rep": """
      SELECT saga_id, seq, step_name, CASE WHEN event_type<>'STEP_FAILED' THEN 'SUCCESS' ELSE 'FAILURE' END AS status,
        event_type='STEP_COMPENSATED' AS is_compensation, event_type, occurred_at,
        CASE WHEN event_type='STEP_FAILED' THEN 'declined by '||step_name END AS error_message,
        substr(saga_id,6) AS key
      FROM sev WHERE step_name IS NOT NULL AND event_type LIKE 'STEP_%'""",
    "clog": """
      SELECT saga_id, id*10+s AS seq, action, CASE WHEN action='FAILED' THEN 'Saga failed at step '||current_step END AS reason,
        payload, updated_at + to_minutes(s) AS "at"
      FROM inst, (VALUES (0,'FAILED'),(1,'RESOLVED'),(2,'FAILED')) e(s,action)
      WHERE status='FAILED' AND id%4<>0 AND (s=0 OR (s=1 AND id%5=0) OR (s=2 AND id%35=0))""",
    "cfail": """
      SELECT f.saga_id, f.reason, f.payload, f."at" AS created_at, coalesce(r.rs > f.seq, false) AS resolved
      FROM (SELECT * FROM clog WHERE action='FAILED' QUALIFY row_number() OVER (PARTITION BY saga_id ORDER BY seq DESC)=1) f
      LEFT JOIN (SELECT saga_id, max(seq) AS rs FROM clog WHERE action='RESOLVED' GROUP BY 1) r USING (saga_id)""",
    "est": """
      SELECT o_orderkey*10+version+copy*5 AS id, 'pay-'||o_orderkey AS aggregate_id, event_type, CAST(version AS INT) AS version,
        'acc-'||o_custkey AS account_id, '{"amount":'||CAST(o_totalprice AS DECIMAL(19,2))||'}' AS payload, start + to_seconds(i*u) AS occurred_at
      FROM ord, (VALUES (1,'PaymentInitiatedV1',0,0),(2,'PaymentSettledV1',4,0),(1,'PaymentInitiatedV1',1,1)) e(version,event_type,i,copy)
      WHERE (version=1 AND copy=0) OR (version=2 AND path='C') OR (copy=1 AND o_orderkey%97=0)""",
    "req": """
      SELECT 'key-'||l_orderkey||'-'||l_linenumber AS idempotency_key, l_partkey||'|'||CAST(l_quantity AS INT) AS body,
        'acc-'||l_suppkey AS account_id, CAST(l_quantity-3 AS DECIMAL(19,4)) AS amount,
        CASE WHEN l_partkey%13=0 THEN ' ' ELSE 'USD' END AS currency, l_shipdate AS requested_at,
        row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_quantity, l_suppkey, l_extendedprice) AS rn,
        first_value(l_partkey||'|'||CAST(l_quantity AS INT)) OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_quantity, l_suppkey, l_extendedprice) AS first_body
      FROM lineitem""",
    "bal": """
      SELECT event_id AS source_event_id, account_id, currency, amount AS delta, occurred_at, payment_id AS aggregate_id, arrival,
        sum(amount) OVER (PARTITION BY account_id, currency ORDER BY arrival ROWS UNBOUNDED PRECEDING) AS balance_after FROM uniq""",
    "acct": """
      SELECT account_id, currency, sum(amount) AS balance, max(occurred_at) AS last_occurred_at, arg_max(event_id, arrival) AS last_source_event_id
      FROM uniq GROUP BY 1,2""",
    "sig": """
      SELECT *, amount>10000 AS amount_over_max, contains(lower(merchant_id),':foreign') AS geo_anomaly,
        count(*) OVER vd AS vd, count(*) OVER vt AS vt,
        count(*) FILTER (amount<9900) OVER st AS sc, coalesce(sum(amount) FILTER (amount<9900) OVER st, 0) AS ss,
        occurred_at >= TIMESTAMP '2024-01-10' AND occurred_at < TIMESTAMP '2024-01-20' AS tight
      FROM pay WINDOW vd AS (PARTITION BY account_id ORDER BY occurred_ms RANGE BETWEEN 3600000 PRECEDING AND CURRENT ROW),
        vt AS (PARTITION BY account_id ORDER BY occurred_ms RANGE BETWEEN 21600000 PRECEDING AND CURRENT ROW),
        st AS (PARTITION BY account_id ORDER BY occurred_ms RANGE BETWEEN 86400000 PRECEDING AND CURRENT ROW)""",
    "scored": """
      SELECT sig.*, sc>=3 AND ss>9900 AS structuring, CASE WHEN tight THEN vt>2 ELSE vd>50 END AS velocity,
        CASE WHEN tight THEN 'rule-tight' ELSE 'rule-default' END AS rule_id, coalesce(baseline_risk,0.1e0) AS baseline_risk
      FROM sig LEFT JOIN prof ON user_id=account_id""",
    "payx": """
      SELECT * REPLACE (occurred_at + to_milliseconds(shift) AS occurred_at, occurred_ms + shift AS occurred_ms) FROM
        (SELECT *, CASE seq%97 WHEN 0 THEN -1893456000000 WHEN 1 THEN 3155760000000 ELSE 0 END AS shift FROM pay)""",
    "sigx": """
      SELECT *, amount>10000 AS amount_over_max, contains(lower(merchant_id),':foreign') AS geo_anomaly,
        count(*) OVER vd AS vd, count(*) OVER vt AS vt,
        count(*) FILTER (amount<9900) OVER st AS sc, coalesce(sum(amount) FILTER (amount<9900) OVER st, 0) AS ss,
        occurred_at >= TIMESTAMP '2024-01-10' AND occurred_at < TIMESTAMP '2024-01-20' AS tight
      FROM payx WINDOW vd AS (PARTITION BY account_id ORDER BY occurred_ms RANGE BETWEEN 3600000 PRECEDING AND CURRENT ROW),
        vt AS (PARTITION BY account_id ORDER BY occurred_ms RANGE BETWEEN 21600000 PRECEDING AND CURRENT ROW),
        st AS (PARTITION BY account_id ORDER BY occurred_ms RANGE BETWEEN 86400000 PRECEDING AND CURRENT ROW)""",
    "scoredx": """
      SELECT sigx.*, sc>=3 AND ss>9900 AS structuring, CASE WHEN tight THEN vt>2 ELSE vd>50 END AS velocity,
        CASE WHEN tight THEN 'rule-tight' ELSE 'rule-default' END AS rule_id, coalesce(baseline_risk,0.1e0) AS baseline_risk
      FROM sigx LEFT JOIN prof ON user_id=account_id""",
    "scored0": """
      SELECT sig.*, sc>=3 AND ss>9900 AS structuring, vd>50 AS velocity, 'rule-default' AS rule_id, coalesce(baseline_risk,0.1e0) AS baseline_risk
      FROM sig LEFT JOIN prof ON user_id=account_id""",
}

SCORE = (
    "least(greatest((0e0 + CASE WHEN amount_over_max THEN 0.35e0 ELSE 0e0 END) + CASE WHEN velocity THEN 0.3e0 ELSE 0e0 END"
    " + CASE WHEN geo_anomaly THEN 0.15e0 ELSE 0e0 END + CASE WHEN structuring THEN 0.45e0 ELSE 0e0 END"
    " + 0.2e0*least(greatest(baseline_risk,0e0),1e0),0e0),1e0)"
)
REASONS = (
    "concat_ws('|', CASE WHEN amount_over_max THEN 'amount_over_max' END, CASE WHEN velocity THEN 'velocity' END,"
    " CASE WHEN geo_anomaly THEN 'geo_anomaly' END, CASE WHEN structuring THEN 'structuring' END)"
)


def _fill() -> None:
    from ..sources import samples

    for name, body in CTES.items():
        for part in ("PATH_EVENTS", "PATH_ENDS", "PATH_STEPS"):
            body = body.replace("{" + part + "}", getattr(samples, part).strip())
        CTES[name] = body


_fill()


def _needed(text: str, seen: list[str]) -> list[str]:
    for name, body in CTES.items():
        if name not in seen and re.search(rf"\b(FROM|JOIN)\s+{name}\b|,\s*{name}\s*[,)]", text):
            _needed(body, seen)
            if name not in seen:
                seen.append(name)
    return seen


def oracle(body: str) -> str:
    """The SQL with just the shared tables it names in front."""
    names = _needed(body, [])
    if not names:
        return body
    head = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in names)
    text = body.strip()
    if text.upper().startswith("WITH "):
        return f"WITH {head},\n{text[5:]}"
    return f"WITH {head}\n{text}"


def comparable(df: DataFrame) -> DataFrame:
    """Types that compare alike in every engine: decimals as double, dates and arrays as text."""
    changed = {}
    for field in df.schema:
        if isinstance(field.dataType, T.DecimalType):
            changed[field.name] = F.col(field.name).cast("double")
        elif isinstance(field.dataType, T.DateType):
            changed[field.name] = F.col(field.name).cast("string")
        elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StringType):
            changed[field.name] = F.concat_ws("|", field.name)
    return df.withColumns(changed) if changed else df


def query(name: str, sql: str | None = None):
    """Registers a query under ``name``; ``sql`` is its oracle."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            use_utc(spark)
            return comparable(build(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return build

    return register
