"""Event store, idempotency and the temporal balance ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import MONEY, WIDE_MONEY, money, not_blank, wide_sum
from ..functions.joins import first_per_key, lookup_join, salted_join, with_first
from ..functions.ordered import CELL_MS, CELL_ROWS, carry_forward, hot_keys, running_totals


def balance_events(deduplicated: DataFrame, opening: DataFrame | None = None, **tuning) -> DataFrame:
    """``balance_after`` per (account, currency) in arrival order.

    Input rows are unique per event. ``opening`` holds balances from before the first row.
    """
    keys = ["account_id", "currency"]
    rows = deduplicated.select(
        F.col("event_id").alias("source_event_id"),
        *keys,
        F.col("amount").cast(MONEY).alias("delta"),
        "occurred_at",
        F.col("payment_id").alias("aggregate_id"),
        F.col("arrival").cast("long").alias("arrival"),
    ).withColumn("balance_after", F.col("delta").cast(WIDE_MONEY))
    hot = hot_keys(rows, keys, tuning.pop("limit", None))
    if opening is not None:
        # An opening balance is one more entry in front of the log, so it needs no join.
        touched = rows.select(*keys).distinct()
        before = opening.join(touched, keys, "left_semi").select(*keys, F.col("balance").alias("balance_after"))
        rows = rows.unionByName(before.withColumn("arrival", F.lit(-1).cast("long")), allowMissingColumns=True)
    running = running_totals(
        rows, keys, ["arrival"], "arrival", ["balance_after"], tuning.pop("width", CELL_ROWS), hot=hot, keep=F.col("arrival") >= 0
    )
    return running.withColumn("balance_after", F.col("balance_after").cast(WIDE_MONEY))


def account_balance(deduplicated: DataFrame) -> DataFrame:
    """Current balance, greatest event time and last applied event per account and currency."""
    return deduplicated.groupBy("account_id", "currency").agg(
        wide_sum(F.col("amount").cast(MONEY)).alias("balance"),
        F.max("occurred_at").alias("last_occurred_at"),
        F.max_by("event_id", "arrival").alias("last_source_event_id"),
    )


def merge_balances(current: DataFrame, changes: DataFrame) -> DataFrame:
    """Upsert of a batch of balances into the current ones; the newer batch names the last event."""
    both = current.withColumn("_new", F.lit(0)).unionByName(changes.withColumn("_new", F.lit(1)))
    return both.groupBy("account_id", "currency").agg(
        wide_sum("balance").alias("balance"),
        F.max("last_occurred_at").alias("last_occurred_at"),
        F.max_by("last_source_event_id", "_new").alias("last_source_event_id"),
    )


def balance_current(probes: DataFrame, balances: DataFrame) -> DataFrame:
    """Balance per probe (account, currency); unknown ones are zero without a time."""
    right = balances.select("account_id", "currency", "balance", F.col("last_occurred_at").alias("as_of"))
    joined = lookup_join(probes, right, ["account_id", "currency"], "left")
    return joined.withColumn("balance", F.coalesce("balance", F.lit(0).cast(WIDE_MONEY)))


def balance_asof(probes: DataFrame, events: DataFrame, **tuning) -> DataFrame:
    """Balance at a time per probe (``probe_id, account_id, currency, at``).

    The newest event at or before ``at`` counts, by event time and then arrival; without one the
    balance is zero and ``at`` is echoed. Probes and events form one ordered log per account, so
    no pair of them is ever built.
    """
    keys = ["account_id", "currency"]
    value = F.struct(F.col("balance_after").alias("balance"), F.col("occurred_at").alias("as_of"))
    facts = events.select(
        *keys,
        F.unix_micros("occurred_at").alias("_pos"),
        F.lit(0).alias("_probe"),
        F.col("arrival").alias("_id"),
        value.alias("_value"),
        F.lit(None).cast("long").alias("probe_id"),
        F.lit(None).cast("timestamp").alias("at"),
    )
    asked = probes.select(
        *keys,
        F.unix_micros("at").alias("_pos"),
        F.lit(1).alias("_probe"),
        F.col("probe_id").cast("long").alias("_id"),
        F.lit(None).cast(facts.schema["_value"].dataType).alias("_value"),
        F.col("probe_id").cast("long").alias("probe_id"),
        "at",
    )
    found = carry_forward(
        facts.unionByName(asked), keys, ["_pos", "_probe", "_id"], "_pos", "_value", CELL_MS * 1000,
        keep=F.col("_probe") == 1, **tuning,
    )
    return found.select(
        "probe_id",
        *keys,
        "at",
        F.coalesce(F.col("_value.balance"), F.lit(0).cast(WIDE_MONEY)).alias("balance"),
        F.coalesce(F.col("_value.as_of"), F.col("at")).alias("as_of"),
    )


def aggregate_versions(events: DataFrame) -> DataFrame:
    return events.groupBy("aggregate_id").agg(F.coalesce(F.max("version"), F.lit(0)).alias("version"))


def event_versions(appends: DataFrame, existing: DataFrame, **tuning) -> DataFrame:
    """Gives appended events the next versions of their aggregate, in (time, id) order."""
    rows = appends.withColumns({"_ms": F.unix_millis("occurred_at"), "version": F.lit(1).cast("long")})
    hot = hot_keys(appends, ["aggregate_id"], tuning.pop("limit", None))
    numbered = running_totals(rows, ["aggregate_id"], ["_ms", "id"], "_ms", ["version"], CELL_MS, hot=hot, **tuning)
    known = aggregate_versions(existing).withColumnRenamed("version", "_max")
    joined = salted_join(numbered, known, ["aggregate_id"], "left", hot=hot)
    total = F.col("version") + F.coalesce(F.col("_max"), F.lit(0))
    return joined.withColumn("version", total.cast("int")).drop("_ms", "_max")


def version_conflicts(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("aggregate_id", "version").agg(F.count(F.lit(1)).alias("events")).filter(F.col("events") > 1)
    )


def payment_state(events: DataFrame) -> DataFrame:
    """Newest event type per payment and the first time of each type."""

    def first(event_type: str) -> Column:
        return F.min(F.when(F.col("event_type") == event_type, F.col("occurred_at")))

    newest = F.max(F.struct("version", "event_type"))
    return events.groupBy("aggregate_id").agg(
        newest["event_type"].alias("state"),
        newest["version"].alias("version"),
        first("PaymentInitiatedV1").alias("initiated_at"),
        first("PaymentSettledV1").alias("settled_at"),
    )


def settled_events(commands: DataFrame, existing: DataFrame, step: str = "LEDGER_APPLY") -> DataFrame:
    """Settled event per ledger command: same payment, amount rounded to cents, no merchant.

    Commands of one payment get the versions after its stored ones, in ``seq`` order. The event id is a hash of saga and step, so a replayed command gives the same event.
    """
    once = first_per_key(commands, ["saga_id"], F.col("seq").asc())
    known = aggregate_versions(existing).select(
        F.col("aggregate_id").alias("payment_id"), F.col("version").alias("_max")
    )
    rows = once.withColumn("_n", F.lit(1).cast("long"))
    hot = hot_keys(once, ["payment_id"])
    numbered = running_totals(rows, ["payment_id"], ["seq", "saga_id"], "seq", ["_n"], CELL_ROWS, hot=hot)
    joined = salted_join(numbered, known, ["payment_id"], "left", hot=hot)
    return joined.select(
        F.md5(F.concat_ws("|", "saga_id", F.lit(step))).alias("event_id"),
        F.col("payment_id").alias("aggregate_id"),
        F.lit("PaymentSettledV1").alias("event_type"),
        (F.coalesce(F.col("_max"), F.lit(0)) + F.col("_n")).cast("int").alias("version"),
        "account_id",
        money("amount").alias("amount"),
        "currency",
        "occurred_at",
    )


def idempotency_outcome(requests: DataFrame, limit: int | None = None) -> DataFrame:
    """Outcome per request: ``created``, ``idempotent_hit`` or ``failed`` (key reused for another body).

    A request without a key is always created. Of requests of one key and arrival the one with the least hash is
    first, then one of equal ones; so a key is created once. Expiry is stored but not consulted on lookup.
    """
    hashed = requests.withColumn("request_hash", F.sha2("body", 256))
    hashed = hashed.withColumn("_place", F.struct("arrival", "request_hash", F.monotonically_increasing_id().alias("row")))
    has_key = F.coalesce(F.col("idempotency_key").rlike(r"\S"), F.lit(False))
    same = F.col("request_hash") == F.col("_first.request_hash")
    outcome = (
        F.when(F.col("_place") == F.col("_first._place"), "created").when(same, "idempotent_hit").otherwise("failed")
    )
    seen = with_first(hashed.filter(has_key), ["idempotency_key"], "_place", ["request_hash"], limit)
    judged = seen.withColumn("outcome", outcome).withColumn("key_hash", F.sha2("idempotency_key", 256)).drop("_first")
    plain = hashed.filter(~has_key).withColumn("outcome", F.lit("created"))
    return judged.unionByName(plain.withColumn("key_hash", F.lit(None).cast("string"))).drop("_place")


def idempotency_records(requests: DataFrame) -> DataFrame:
    """Stored record per key: the first request, kept for one day."""
    first = F.min(F.struct("arrival", F.sha2("body", 256).alias("request_hash"), "requested_at")).alias("r")
    keyed = requests.filter(not_blank("idempotency_key").isNotNull())
    return keyed.groupBy(F.sha2("idempotency_key", 256).alias("key_hash")).agg(first).select(
        "key_hash",
        "r.request_hash",
        F.col("r.requested_at").alias("created_at"),
        (F.col("r.requested_at") + F.expr("INTERVAL 1 DAY")).alias("expires_at"),
    )


def processed_commands(commands: DataFrame, processed: DataFrame, limit: int | None = None) -> DataFrame:
    """Marks each delivery of a command ``executed`` or ``replayed`` and gives the stored reply.

    A command already in ``processed`` is never executed again; of the others the first delivery is.
    """
    keys = ["saga_id", "step_name"]
    stored = processed.select(*keys, F.struct(F.lit(-1).cast("long").alias("seq"), F.col("reply_payload")).alias("_r"))
    fresh = commands.groupBy(*keys).agg(F.min(F.struct(F.col("seq").cast("long").alias("seq"), F.col("reply_payload"))).alias("_r"))
    first = stored.unionByName(fresh).groupBy(*keys).agg(F.min("_r").alias("_r"))
    joined = salted_join(commands.drop("reply_payload"), first, keys, "inner", limit)
    return joined.select(
        *keys,
        "seq",
        F.when(F.col("seq") == F.col("_r.seq"), "executed").otherwise("replayed").alias("outcome"),
        F.col("_r.reply_payload").alias("reply_payload"),
    )


def outbox_messages(payments: DataFrame) -> DataFrame:
    """Lifecycle start message per payment, keyed by its saga."""
    body = F.struct(
        F.col("saga_id").alias("sagaId"),
        F.lit("PaymentSaga").alias("sagaType"),
        F.col("payment_id").alias("paymentId"),
        F.col("account_id").alias("accountId"),
        F.col("amount").cast("decimal(19,2)").alias("amount"),
        "currency",
        F.col("merchant_id").alias("merchantId"),
    )
    return payments.select(
        F.col("saga_id").alias("partitioning_key"),
        F.lit("SagaStart:PaymentSaga").alias("type"),
        F.to_json(body).alias("payload"),
        F.col("occurred_at").alias("created_at"),
    )
