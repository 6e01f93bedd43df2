"""Streaming jobs over the driver's tables, drained with ``availableNow``; the oracle is the batch twin."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import fraud as D
from ..operators import landing as L
from ..operators import monitoring
from ..operators import replay as R
from ..operators import rules
from ..plans import merge
from ..session import shared_dir, use_utc
from ..sources import samples as S
from ..sources.tables import read_table, utc_times
from ..sources.topics import file_stream
from ..streaming import alarms, jobs, lookback, requests, sagas
from .base import REASONS, SCORE, query
from .detection import _ALERTS, _GOOD, _HOURLY, _alert_records, _saga_records, _strict_records


def _stream(spark, folder, table):
    use_utc(spark)
    folder = folder.rstrip("/")
    schema = spark.read.parquet(f"{folder}/{table}.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet")
    return utc_times(reader.parquet(folder))


def _payments(spark, folder):
    return S.shape_payments(_stream(spark, folder, "events"))


#: Rows of a file of a made topic, about.
_FILE_ROWS = 500_000


def _files(rows):
    """Files of each delivery of a topic with so many rows: as many for all, so that a batch is one delivery."""
    return max(1, min(256, rows // _FILE_ROWS))


def _deliver(part, path, files):
    """Appends a delivery to a topic as exactly so many files, however few rows it has."""
    spark, rows = part.sparkSession, part
    if files > 1:
        rows = part.repartition(files, F.xxhash64(*part.columns))
    else:
        rows = part.coalesce(1)

    def written():
        try:
            return len(spark.read.schema(part.schema).parquet(path).inputFiles())
        except AnalysisException:
            return 0

    wanted = (written() if files > 1 else 0) + files
    rows.write.mode("append").option("maxRecordsPerFile", 0).parquet(path)
    while files > 1 and written() < wanted:
        spark.createDataFrame([], part.schema).coalesce(1).write.mode("append").parquet(path)


def _drain(spark, name, start):
    root = shared_dir(spark, name)
    start(root).awaitTermination()
    return root


@query(
    "stream_hourly_metrics",
    f"SELECT * FROM ({_HOURLY}) WHERE window_end <= (SELECT max(occurred_at) FROM pay) - INTERVAL 5 SECOND",
)
def _(spark, folder):
    """Hours still open at the end of the input are not written."""
    root = _drain(spark, "hourly", lambda r: jobs.hourly_metrics(_payments(spark, folder), r))
    return jobs.read_batches(spark, root, "hourly_metrics")


@query(
    "stream_metric_records",
    f"""SELECT epoch_ms(window_start)||':'||currency AS "key", currency, payment_count, total_amount FROM ({_HOURLY})
    WHERE window_end <= (SELECT max(occurred_at) FROM pay) - INTERVAL 5 SECOND""",
)
def _(spark, folder):
    """The published records of closed hours, with their value read back."""
    root = _drain(spark, "hourly", lambda r: jobs.hourly_metrics(_payments(spark, folder), r))
    body = F.from_json("value", "currency string, count long, totalAmount double")
    return jobs.read_batches(spark, root, "metric_records").select(
        "key", body["currency"].alias("currency"), body["count"].alias("payment_count"), body["totalAmount"].alias("total_amount")
    )


def _detected(spark, folder):
    records = S.raw_payment_records(_payments(spark, folder))
    rule = rules.active_rule(S.rule_log(spark))
    return _drain(
        spark, "detect", lambda r: jobs.detect(records, r, lambda: rule, lambda: S.profiles(spark, folder))
    )


def _tight(spark, folder):
    """Three files of the raw topic, the tight rule from the second batch on, and some rows dated 1970.

    The windows are kept in keyed state; rules arrive as a topic of their own.
    """
    path, last = shared_dir(spark, "tight"), read_table(spark, folder, "events").count()
    long_ago = F.when(F.col("seq") % 101 == 50, F.timestamp_millis(F.col("seq") * 1000)).otherwise(F.col("occurred_at"))
    moved = S.payments(spark, folder).withColumn("occurred_at", long_ago).withColumn("occurred_ms", F.unix_millis(long_ago))
    records, files = S.raw_payment_records(moved), _files(last // 3)
    for k in range(3):
        _deliver(records.filter((F.col("offset") * 3 >= k * last) & (F.col("offset") * 3 < (k + 1) * last)), path, files)
    topic, log = shared_dir(spark, "tight-rules"), S.rule_log(spark)
    for k in range(2):
        log.filter(F.col("offset") == k).coalesce(1).write.mode("append").parquet(topic)
    rules = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(topic)
    stream = file_stream(spark, path, files_per_batch=files)
    root = shared_dir(spark, "lookback")
    for q in lookback.detect(stream, rules, root, lambda: S.profiles(spark, folder), shards=16):
        q.awaitTermination()
    return root


_TIGHT = f"""
  moved AS (SELECT * REPLACE (CASE WHEN seq%101=50 THEN make_timestamp(seq*1000000) ELSE occurred_at END AS occurred_at,
      CASE WHEN seq%101=50 THEN seq*1000 ELSE occurred_ms END AS occurred_ms), seq*3 >= (SELECT count(*) FROM events) AS tight
    FROM raw WHERE {_GOOD}),
  seen AS (SELECT *, amount>10000 AS amount_over_max, contains(lower(merchant_id),':foreign') AS geo_anomaly,
      count(*) OVER vd AS vd, count(*) OVER vt AS vt, count(*) FILTER (amount<9900) OVER st AS sc, coalesce(sum(amount) FILTER (amount<9900) OVER st, 0) AS ss
    FROM moved WINDOW vd AS (PARTITION BY account_id ORDER BY occurred_ms RANGE BETWEEN 3600000 PRECEDING AND CURRENT ROW),
      vt AS (PARTITION BY account_id ORDER BY occurred_ms RANGE BETWEEN 21600000 PRECEDING AND CURRENT ROW),
      st AS (PARTITION BY account_id ORDER BY occurred_ms RANGE BETWEEN 86400000 PRECEDING AND CURRENT ROW)),
  live AS (SELECT seen.*, sc>=3 AND ss>9900 AS structuring, CASE WHEN tight THEN vt>2 ELSE vd>50 END AS velocity,
      CASE WHEN tight THEN 'rule-tight' ELSE 'rule-default' END AS rule_id, coalesce(baseline_risk,0.1e0) AS baseline_risk
    FROM seen LEFT JOIN prof ON user_id=account_id)"""


@query("stream_fraud_alerts_tight", f"WITH {_TIGHT} SELECT * FROM ({_ALERTS} FROM live) WHERE reasons<>''")
def _(spark, folder):
    return jobs.read_batches(spark, _tight(spark, folder), "alerts")


# Only payments that parse are seen by the stream, so its windows hold fewer rows than those of the
# batch queries.
_SEEN = f"""
  seen AS (SELECT *, amount>10000 AS amount_over_max, contains(lower(merchant_id),':foreign') AS geo_anomaly,
      count(*) OVER vd AS vd, count(*) FILTER (amount<9900) OVER st AS sc, coalesce(sum(amount) FILTER (amount<9900) OVER st, 0) AS ss
    FROM raw WHERE {_GOOD} WINDOW vd AS (PARTITION BY account_id ORDER BY occurred_ms RANGE BETWEEN 3600000 PRECEDING AND CURRENT ROW),
      st AS (PARTITION BY account_id ORDER BY occurred_ms RANGE BETWEEN 86400000 PRECEDING AND CURRENT ROW)),
  live AS (SELECT seen.*, sc>=3 AND ss>9900 AS structuring, vd>50 AS velocity, 'rule-default' AS rule_id, coalesce(baseline_risk,0.1e0) AS baseline_risk
    FROM seen LEFT JOIN prof ON user_id=account_id)"""


@query("stream_fraud_alerts", f"WITH {_SEEN} SELECT * FROM ({_ALERTS} FROM live) WHERE reasons<>''")
def _(spark, folder):
    return jobs.read_batches(spark, _detected(spark, folder), "alerts")


@query(
    "stream_user_scores",
    f"WITH {_SEEN} SELECT account_id AS user_id, {SCORE} AS score, payment_id AS last_payment_id, occurred_ms AS updated_at FROM live"
    " QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY seq DESC)=1",
)
def _(spark, folder):
    return D.latest_scores(jobs.read_batches(spark, _detected(spark, folder), "scores"))


@query(
    "stream_dead_letter",
    f"""SELECT value AS raw, CASE WHEN k%10=3 THEN 'invalid json' ELSE 'missing or blank field: accountId' END AS error,
      TIMESTAMP '{S.AS_OF}' AS occurred_at FROM raw WHERE NOT ({_GOOD})""",
)
def _(spark, folder):
    return jobs.read_batches(spark, _detected(spark, folder), "dead_letters")


@query(
    "stream_balances",
    """SELECT account_id, currency, CAST(sum(amount) AS DOUBLE) AS balance, max(occurred_at) AS last_occurred_at, arg_max(event_id, seq) AS last_source_event_id
    FROM pay GROUP BY 1,2""",
)
def _(spark, folder):
    arriving = _payments(spark, folder).withColumn("arrival", F.col("seq"))
    copies = arriving.withColumn("_copy", F.explode(F.when(F.col("seq") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    root = _drain(spark, "balances", lambda r: jobs.balances(copies.drop("_copy"), r))
    return jobs.current_balances(spark, root)


@query(
    "stream_saga_outcomes",
    "SELECT substr(event_type,6) AS outcome, count(*) AS sagas FROM sev WHERE event_type IN ('SAGA_COMPLETED','SAGA_FAILED','SAGA_COMPENSATED') GROUP BY 1",
)
def _(spark, folder):
    events = S.shape_saga_events(S.shape_orders(_stream(spark, folder, "orders")))
    root = _drain(spark, "outcomes", lambda r: jobs.saga_outcomes(events, r))
    return jobs.newest_batch(spark, root, "saga_outcomes")


@query(
    "stream_landing",
    """SELECT event_id, payment_id, CASE WHEN k%10=7 THEN '' ELSE account_id END AS account_id, CAST(amount AS DOUBLE) AS amount,
      currency, merchant_id, occurred_at, seq AS "offset" FROM raw WHERE k%10<>3""",
)
def _(spark, folder):
    records = S.raw_payment_records(_payments(spark, folder))
    root = _drain(spark, "landing", lambda r: jobs.land(records, r))
    landed = jobs.read_batches(spark, root, "payment_events").drop("month")
    return L.dedup_replacing(landed, L.SORT_KEYS["payment_events"])


@query(
    "merge_landed",
    """SELECT event_id, payment_id, CASE WHEN k%10=7 THEN '' ELSE account_id END AS account_id, CAST(amount AS DOUBLE) AS amount,
      currency, merchant_id, occurred_at, CASE WHEN seq%20=0 THEN seq+1000000000 ELSE seq END AS "offset" FROM raw WHERE k%10<>3""",
)
def _(spark, folder):
    """Three batches, the last of which repeats rows of both; merged after the first and the third."""
    path, root, records = shared_dir(spark, "deliveries"), shared_dir(spark, "merged"), S.raw_payment_records(S.payments(spark, folder))
    early = F.col("offset") % 3 < 2
    again = records.filter(F.col("offset") % 20 == 0).withColumn("offset", F.col("offset") + 1_000_000_000)
    for k, part in enumerate((records.filter(early), records.filter(~early), again)):
        part.coalesce(1).write.mode("append").parquet(path)
        jobs.land(file_stream(spark, path), root).awaitTermination()
        if k != 1:
            merge.merge(spark, root, "payment_events")
    merge.vacuum(spark, root, "payment_events", keep=1)
    return merge.read_landed(spark, root, "payment_events")


@query(
    "stream_payment_dlq",
    f"""SELECT 'payment.events' AS topic, CAST(seq%3 AS INT) AS "partition", seq AS "offset", value AS raw_message,
      'cannot parse input: not JSON' AS error, TIMESTAMP '{S.AS_OF}' AS ingested_at FROM raw WHERE k%10=3""",
)
def _(spark, folder):
    root = _drain(spark, "landing", lambda r: jobs.land(S.raw_payment_records(_payments(spark, folder)), r))
    return jobs.read_batches(spark, root, "payment_events_dlq")


def _topic(spark, name, records):
    """A topic kept as a file, with every 13th record broken, as a stream."""
    path = shared_dir(spark, name)
    broken = F.when(F.col("offset") % 13 == 5, F.concat(F.lit("broken "), F.col("value"))).otherwise(F.col("value"))
    records.withColumn("value", broken).write.parquet(path)
    return file_stream(spark, path)


def _landed(spark, table, records):
    """Landed rows and, marked, the records that could not be landed."""
    root = _drain(spark, table, lambda r: jobs.land(_topic(spark, f"{table}-topic", records), r, table))
    good = jobs.read_batches(spark, root, table).drop("month")
    bad = jobs.read_batches(spark, root, f"{table}_dlq").select("offset", F.col("error").alias("rejected"))
    return good.withColumn("rejected", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)


_REJECT = "'cannot parse input: not JSON'"


@query(
    "stream_land_alerts",
    f"""SELECT offset_ AS "offset", CASE WHEN ok THEN alert_id END AS alert_id, CASE WHEN ok THEN user_id END AS user_id, CASE WHEN ok THEN score END AS score,
      CASE WHEN ok THEN CASE WHEN seq%2=0 THEN occurred_at ELSE TIMESTAMP '1970-01-01' END END AS occurred_at, CASE WHEN NOT ok THEN {_REJECT} END AS rejected
    FROM (SELECT *, seq AS offset_, seq%13<>5 AS ok FROM al)""",
)
def _(spark, folder):
    both = _landed(spark, "fraud_alerts", _alert_records(spark, folder))
    return both.select("offset", "alert_id", "user_id", "score", "occurred_at", "rejected")


@query(
    "stream_land_metrics",
    f"""SELECT n AS "offset", CASE WHEN ok THEN window_start END AS window_start, CASE WHEN ok THEN currency END AS currency, CASE WHEN ok THEN payment_count END AS payment_count,
      CASE WHEN ok THEN total_amount END AS total_amount, CASE WHEN NOT ok THEN {_REJECT} END AS rejected
    FROM (SELECT *, n%13<>5 AS ok FROM (SELECT *, row_number() OVER (ORDER BY window_start, currency) AS n FROM ({_HOURLY})))""",
)
def _(spark, folder):
    hourly = monitoring.hourly_metrics(S.payments(spark, folder))
    keyed = L.metric_records(hourly)
    number = F.row_number().over(Window.orderBy(F.split("key", ":")[0].cast("long"), F.split("key", ":")[1])).cast("long")
    made = keyed.select(
        F.lit("payment_metrics").alias("topic"), F.lit(0).alias("partition"), number.alias("offset"), "key", "value",
        F.lit(S.AS_OF).cast("timestamp").alias("ingest_ts"),
    )
    both = _landed(spark, "payment_metrics_hourly", made)
    return both.select("offset", "window_start", "currency", "payment_count", "total_amount", "rejected")


@query(
    "stream_land_saga_events",
    f"""SELECT seq AS "offset", CASE WHEN ok THEN CASE WHEN n%11<>0 THEN saga_id ELSE '' END END AS saga_id, CASE WHEN ok THEN CASE WHEN n%5<>0 THEN event_type ELSE '' END END AS event_type,
      CASE WHEN ok THEN status END AS status, CASE WHEN ok THEN occurred_at END AS occurred_at, CASE WHEN NOT ok THEN {_REJECT} END AS rejected
    FROM (SELECT *, seq//10 AS n, seq%13<>5 AS ok FROM sev)""",
)
def _(spark, folder):
    both = _landed(spark, "saga_events", _saga_records(spark, folder))
    return both.select("offset", "saga_id", "event_type", "status", "occurred_at", "rejected")


_STRICT = "replace(value, 'pay-'||seq, '00000000-0000-4000-8000-'||lpad(CAST(seq AS VARCHAR),12,'0'))"


def _projected(spark, folder):
    """The ledger projection over three files of the raw topic."""
    path, last = shared_dir(spark, "strict"), read_table(spark, folder, "events").count()
    strict = _strict_records(spark, folder)
    for k in range(3):
        part = strict.filter((F.col("offset") * 3 >= k * last) & (F.col("offset") * 3 < (k + 1) * last))
        part.coalesce(1).write.mode("append").parquet(path)
    root = shared_dir(spark, "projection")
    for q in jobs.projection(file_stream(spark, path, files_per_batch=1), root):
        q.awaitTermination()
    return root


@query(
    "stream_projection_dlt",
    f"""SELECT 'payment.events.DLT' AS topic, CAST(seq%3 AS INT) AS "partition", seq AS "offset", account_id AS "key",
      CASE WHEN k%10=3 THEN 'invalid json' WHEN seq%6=0 THEN 'paymentId is not a UUID' ELSE 'missing or blank field: accountId' END AS error,
      CASE WHEN k%10=3 OR seq%6=0 THEN value ELSE {_STRICT} END AS value
    FROM raw WHERE NOT ({_GOOD}) OR seq%6=0""",
)
def _(spark, folder):
    return jobs.read_batches(spark, _projected(spark, folder), "dlt")


@query(
    "stream_projection_balances",
    f"""SELECT account_id, currency, CAST(sum(amount) AS DOUBLE) AS balance, max(occurred_at) AS last_occurred_at, arg_max(event_id, seq) AS last_source_event_id
    FROM raw WHERE {_GOOD} AND seq%6<>0 GROUP BY 1,2""",
)
def _(spark, folder):
    return jobs.current_balances(spark, _projected(spark, folder))


@query(
    "stream_timed_out_steps",
    """SELECT saga_id, step_name, 'FAILURE' AS status, 'Step timed out after 30s' AS error_message, false AS is_compensation FROM stp
    WHERE status='EXECUTING' AND started_at < (SELECT least(max(started_at), max(completed_at)) FROM stp) - INTERVAL 35 SECOND""",
)
def _(spark, folder):
    """Steps still open when the streams have moved on by the timeout and the watermark's delay."""
    steps = S.shape_saga_steps(spark, S.shape_orders(_stream(spark, folder, "orders")))
    named = steps.withColumn("saga_id", F.concat(F.lit("saga-"), F.col("saga_instance_id")))
    started = named.filter("started_at is not null")
    replied = named.filter("completed_at is not null").withColumnRenamed("completed_at", "replied_at")
    root = _drain(spark, "timeouts", lambda r: jobs.timed_out_steps(started, replied, r))
    return jobs.read_batches(spark, root, "timed_out_steps")


# Replay


@query(
    "saga_replay",
    """SELECT saga_id, step_order, step_name, s.status, retry_count, CASE WHEN s.status='FAILED' THEN error_message END AS error_message,
      i.status AS saga_status, current_step FROM stp s JOIN (SELECT saga_id, status, current_step FROM inst) i USING (saga_id)""",
)
def _(spark, folder):
    return R.step_states(R.replay(S.saga_replies(spark, folder)))


@query(
    "saga_replay_operator_actions",
    """SELECT saga_id, CASE WHEN forced THEN 'COMPLETED' ELSE 'EXECUTING' END AS saga_status, current_step,
      CASE WHEN forced THEN CAST(retries AS INT) ELSE CAST(retries+1 AS INT) END AS retry_count
    FROM (SELECT i.saga_id, i.id%2=0 AS forced, i.current_step, s.retry_count AS retries FROM inst i JOIN stp s ON s.saga_id=i.saga_id AND s.step_name=i.current_step
      WHERE i.status='FAILED')""",
)
def _(spark, folder):
    """Failed lifecycles: operators force the even ones to complete and retry the step of the others."""
    replies = S.saga_replies(spark, folder)
    failed = S.saga_instances(spark, folder).filter("status = 'FAILED'")
    action = F.when(F.col("id") % 2 == 0, "FORCE_COMPLETE").otherwise("RETRY")
    acts = failed.select("saga_id", F.lit(10**15).alias("seq"), action.alias("action"))
    log = replies.join(failed.select("saga_id"), "saga_id", "left_semi").unionByName(acts, allowMissingColumns=True)
    done = R.step_states(R.replay(log))
    return done.filter("step_name = current_step").select("saga_id", "saga_status", "current_step", "retry_count")


def _in_batches(spark, name, log, parts, order="seq"):
    """A table as a stream of deliveries, one a batch, in the given order."""
    path = shared_dir(spark, name)
    last, rows = log.agg(F.max(order) + 1, F.count("*")).first()
    files = _files(rows // parts)
    for k in range(parts):
        _deliver(log.filter((F.col(order) * parts >= k * last) & (F.col(order) * parts < (k + 1) * last)), path, files)
    return spark.readStream.schema(log.schema).option("maxFilesPerTrigger", files).parquet(path)


@query(
    "stream_saga_replay",
    """SELECT saga_id, step_order, step_name, s.status, retry_count, CASE WHEN s.status='FAILED' THEN error_message END AS error_message,
      i.status AS saga_status, current_step FROM stp s JOIN (SELECT saga_id, status, current_step FROM inst) i USING (saga_id)""",
)
def _(spark, folder):
    """The last states of the steps after three batches of replies."""
    replies = S.saga_replies(spark, folder).select("saga_id", "seq", "step_name", "status", "error_message", "is_compensation")
    # Lifecycles are cut by the batches: replies are numbered within them and mixed.
    mixed = replies.withColumn("arrival", F.pmod(F.col("seq"), F.lit(10)))
    root = shared_dir(spark, "saga-replay")
    sagas.replay(_in_batches(spark, "replies", mixed, 3, "arrival"), root).awaitTermination()
    return R.step_states(sagas.newest_states(jobs.read_batches(spark, root, "saga_replay")))


@query(
    "stream_step_timeouts",
    """SELECT saga_id, step_name, CAST(attempt AS INT) AS attempt, started_at + to_seconds(30 * attempt) AS timed_out_at, 'FAILURE' AS status
    FROM (SELECT *, unnest(range(1, CASE WHEN step_name='NOTIFY' THEN 5 ELSE 2 END)) AS attempt FROM stp WHERE status='EXECUTING')
    WHERE started_at < (SELECT greatest(max(started_at), max(completed_at)) FROM stp) - to_seconds(5 + 30 * attempt)""",
)
def _(spark, folder):
    """Timers of the steps without a reply; that of a retryable step is set again for each of its retries."""
    steps = S.shape_saga_steps(spark, S.shape_orders(_stream(spark, folder, "orders")))
    named = steps.withColumn("saga_id", F.concat(F.lit("saga-"), F.col("saga_instance_id")))
    started = named.filter("started_at is not null")
    replied = named.filter("completed_at is not null").withColumnRenamed("completed_at", "replied_at")
    root = _drain(spark, "timers", lambda r: sagas.step_timeouts(started, replied, r))
    return jobs.read_batches(spark, root, "step_timeouts").select("saga_id", "step_name", "attempt", "timed_out_at", "status")


@query(
    "stream_idempotency",
    """SELECT idempotency_key, body, requested_at, account_id, CASE WHEN row_number() OVER w = 1 THEN 'created' WHEN body = first_value(body) OVER w THEN 'idempotent_hit' ELSE 'failed' END AS outcome,
      CASE WHEN body = first_value(body) OVER w THEN 'to '||first_value(body) OVER w END AS reply
    FROM req WINDOW w AS (PARTITION BY idempotency_key ORDER BY requested_at, sha256(body))""",
)
def _(spark, folder):
    """Requests in three batches by their time, so that keys are used again in later ones."""
    day = F.unix_date(F.col("requested_at").cast("date"))
    all_ = S.requests(spark, folder).select("idempotency_key", "body", "requested_at", "account_id", (day.cast("long") * 86_400_000).alias("arrival"))
    with_reply = all_.withColumn("reply", F.concat(F.lit("to "), "body"))
    first, last, rows = all_.agg(F.min("arrival"), F.max("arrival"), F.count("*")).first()
    path, files = shared_dir(spark, "requests"), _files(rows // 3)
    for k in range(3):
        low, high = (first + (last + 1 - first) * n // 3 for n in (k, k + 1))
        _deliver(with_reply.filter((F.col("arrival") >= low) & (F.col("arrival") < high)), path, files)
    stream = spark.readStream.schema(with_reply.schema).option("maxFilesPerTrigger", files).parquet(path)
    root = _drain(spark, "idempotency", lambda r: requests.judge(stream, r, shards=16))
    return jobs.read_batches(spark, root, "idempotency").select("idempotency_key", "body", "requested_at", "account_id", "outcome", "reply")


def _alarm_stream_sql():
    from .ledger import _QUIET, _alarm_sql

    return _alarm_sql("SELECT occurred_at AS t FROM sa", _QUIET)


@query("stream_alarm_high_fraud", _alarm_stream_sql())
def _(spark, folder):
    """Alerts in four batches by time, so that holds cross the ends of batches, and then a tick of the clock."""
    from .ledger import _QUIET
    from .warehouse import alerts

    path = shared_dir(spark, "alerts")
    rows = alerts(spark, folder).select(F.lit("high-fraud").alias("alarm"), F.col("occurred_at").alias("at"), F.lit(True).alias("counts")).filter("at IS NOT NULL").persist()
    first, last = rows.agg(F.min("at"), F.max("at")).first()
    for k in range(4):
        low, high = (first + (last - first) * n / 4 for n in (k, k + 1))
        part = rows.filter((F.col("at") >= low) & ((F.col("at") < high) | F.lit(k == 3)))
        part.coalesce(1).write.mode("append").parquet(path)
    ticks = rows.limit(1).select("alarm", F.explode(F.array(F.lit(1), F.lit(2))).alias("d")).select("alarm", (F.lit(last) + F.make_dt_interval("d")).alias("at"), F.lit(False).alias("counts"))
    ticks.coalesce(1).write.mode("append").parquet(path)
    schema = rows.schema
    rows.unpersist()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    root = _drain(spark, "alarms", lambda r: alarms.watch(stream, r, [alarms.Alarm("high-fraud", _QUIET)]))
    return alarms.spans(spark, root).drop("alarm")


@query("saga_lifecycle_events", "SELECT saga_id, event_type, step_name, status, attempt FROM sev")
def _(spark, folder):
    return R.lifecycle_events(R.replay(S.saga_replies(spark, folder))).drop("seq", "part")
