"""Detection with look-back windows in keyed state.

Payments are dealt to groups by account. A group keeps the payments of its accounts by day and bucket of accounts
(``blocks``), so a batch reads the days and buckets that its own windows reach, however long the history is, and late
payments find the neighbours of their time. All accounts of a group are counted at once. A live job lets state expire a
while after it was last written; a job that drains its source and stops keeps it, as Spark lets one with expiry run for
ever. One checkpoint is for one of the two. Records of the rule topic go to every group, where the last one holds for
all payments from its batch on.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.columns import MONEY
from ..operators import fraud, parsing
from ..operators.fraud import HOUR_MS
from ..sources import schemas
from ..sources.schemas import DEFAULT_RULE, FRAUD_RULE
from . import blocks
from .jobs import DAY_MS, Trigger, _start, _start_keyed, batch_folder

# Processors travel with the job: executors need not have this package installed. What they use must be in these modules
# or a plain value, no other module of the package.
for module in (sys.modules[__name__], schemas):
    cloudpickle.register_pickle_by_value(module)

SHARDS = 256
#: Time that state outlives its last change. It must reach as far back as payments may look while they arrive.
KEEP_MS = 7 * DAY_MS
_SCALE = int(MONEY.rstrip(")").split(",")[1])
_RULE = FRAUD_RULE.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ").replace(",", ", ")
_PAYMENT = "account_id string, event_id string, payment_id string, merchant_id string, amount double, units long, occurred_ms long, seq long"
_COUNTS = "window_count long, small_count long, small_units long"
OUTPUT = f"{_PAYMENT}, {_COUNTS}, {_RULE}"
_NAMES = [c.split()[0] for c in OUTPUT.split(", ")]
_COLUMNS = [c.split()[0] for c in _PAYMENT.split(", ")]


def window_counts(ms: np.ndarray, seq: np.ndarray, amount: np.ndarray, units: np.ndarray, asked: np.ndarray, rule, account: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """For the rows asked for: payments in the velocity window, and count and sum of the small ones in the structuring window.

    A window reaches from its width before a row to the row itself, within the row's account (a number; all rows are of
    one if None); rows of one time count in order of ``seq``.
    """
    account = np.zeros(len(ms), np.int64) if account is None else account
    order = np.lexsort((seq, ms, account))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    small = amount[order] < rule.structuring_threshold
    counted = np.concatenate(([0], np.cumsum(small)))
    summed = np.concatenate(([0], np.cumsum(np.where(small, units[order], 0))))

    def begin(width: int) -> np.ndarray:
        """Places where the windows begin: each is sorted in before the rows of its time."""
        is_row = np.concatenate((np.zeros(len(asked), bool), np.ones(len(ms), bool)))
        times, owners = np.concatenate((ms[asked] - width, ms)), np.concatenate((account[asked], account))
        merged = np.lexsort((is_row, times, owners))
        before = np.cumsum(is_row[merged])
        found = np.empty(len(asked), np.int64)
        starts = ~is_row[merged]
        found[merged[starts]] = before[starts]
        return found

    end = place[asked] + 1
    fast, slow = begin(rule.velocity_window_ms), begin(rule.structuring_window_hours * HOUR_MS)
    return end - fast, counted[end] - counted[slow], summed[end] - summed[slow]


def _typed(values) -> schemas.FraudRule:
    """A rule from values of any kind of number."""
    kinds = {"long": int, "double": float, "boolean": bool, "string": str}
    return schemas.FraudRule(**{f.name: kinds[f.dataType.typeName()](values[f.name]) for f in FRAUD_RULE.fields})


_ARROW = {"string": pa.string(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}


class LookBack(StatefulProcessor):
    """Counts the look-back windows of new payments from the days and buckets that they reach."""

    def __init__(self, bucket_ms: int, keep_ms: int | None):
        self.bucket_ms, self.keep_ms = bucket_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rule = handle.getValueState("rule", _RULE)
        self.rows = blocks.Buckets(handle, "payments", self.keep_ms)

    def _in_force(self, records: pa.Table) -> schemas.FraudRule:
        """The last record written; a disabled one gives way to the built-in rule."""
        if records.num_rows:
            newest = pc.sort_indices(records["seq"], sort_keys=[("", "ascending")])[-1].as_py()
            last = _typed(json.loads(records["rule"][newest].as_py()))
            rule = last if last.enabled else DEFAULT_RULE
            self.rule.update(tuple(getattr(rule, f) for f in FRAUD_RULE.names))
            return rule
        return _typed(dict(zip(FRAUD_RULE.names, self.rule.get()))) if self.rule.exists() else DEFAULT_RULE

    def _counted(self, new: pa.Table, rule, now: int) -> tuple[np.ndarray, ...]:
        """The window counts of new payments, which are stored."""
        reach = max(rule.velocity_window_ms, rule.structuring_window_hours * HOUR_MS)
        number, accounts = blocks.distinct(new["account_id"])
        ms, hashes = new["occurred_ms"].to_numpy(), new[blocks.HASH].to_numpy()
        own, first = ms // self.bucket_ms, (ms - reach) // self.bucket_ms
        self.rows.open(hashes, own)
        wide = [(hashes[at], first[at] + n) for n in range(int((own - first).max()) + 1) if (at := first + n <= own).any()]
        held = self.rows.held(*(np.concatenate(v) for v in zip(*wide)))
        columns = ["account_id", blocks.HASH, "occurred_ms", "seq", "amount", "units"]
        fresh = new.select(columns).append_column("written_ms", pa.array(np.full(len(ms), now)))
        every, before = fresh, 0
        if held is not None:
            day = held["occurred_ms"].to_numpy() // self.bucket_ms
            entry, mine = np.concatenate((self.rows.bucket(held[blocks.HASH].to_numpy()), self.rows.bucket(hashes))), np.concatenate((day, own))
            _, days = np.unique(mine, return_inverse=True)
            entry = entry * (int(days.max()) + 1) + days
            rewritten = np.isin(entry[: len(day)], entry[len(day) :])
            before = int(rewritten.sum())
            alive = np.ones(len(day), bool) if self.keep_ms is None else held["written_ms"].to_numpy() > now - self.keep_ms
            owner = blocks.places(held["account_id"], accounts)
            if self.keep_ms is not None:  # What is written again lives on, by account and day.
                touched = alive & np.isin(owner * len(mine) + days[: len(day)], number * len(mine) + days[len(day) :]) & (owner >= 0)
                held = held.set_column(held.column_names.index("written_ms"), "written_ms", pa.array(np.where(touched, now, held["written_ms"].to_numpy())))
            stored = pa.concat_tables([held.filter(pa.array(alive & rewritten)), fresh])
            every = pa.concat_tables([held.filter(pa.array(alive & (owner >= 0))), fresh])
            number = np.concatenate((owner[alive & (owner >= 0)], number))
        else:
            stored = fresh
        self.rows.put(stored, before, stored["occurred_ms"].to_numpy() // self.bucket_ms)
        asked = np.arange(every.num_rows - len(ms), every.num_rows)
        return window_counts(*(every[c].to_numpy() for c in columns[2:]), asked, rule, number)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        table = blocks.read(rows)
        is_rule = pc.is_valid(table["rule"])
        rule = self._in_force(table.filter(is_rule))
        payments = table.filter(pc.invert(is_rule)).combine_chunks()
        if not payments.num_rows:
            return
        now = 0 if self.keep_ms is None else timerValues.getCurrentProcessingTimeInMs()
        counts = self._counted(payments, rule, now)
        told = payments.select(_COLUMNS)
        for name, values in zip(("window_count", "small_count", "small_units"), counts):
            told = told.append_column(name, pa.array(values, pa.int64()))
        for f in FRAUD_RULE.fields:
            told = told.append_column(f.name, pa.repeat(pa.scalar(getattr(rule, f.name), _ARROW[f.dataType.typeName()]), told.num_rows))
        yield from blocks.give(told)

    def close(self) -> None:
        pass


def counted(records: DataFrame, rule_log: DataFrame, shards: int = SHARDS, bucket_ms: int = DAY_MS, keep_ms: int | None = KEEP_MS) -> DataFrame:
    """Payments of the raw topic with their window counts and the rule in force; ``rule_log`` is the topic of rules.

    State never expires if ``keep_ms`` is None.
    """
    payments = parsing.valid_payments(parsing.parse_payments(records))
    units = (F.col("amount").cast(MONEY) * F.lit(10**_SCALE)).cast("long")
    known = payments.filter(F.col("account_id").isNotNull()).withColumns({"units": units, "amount": F.col("amount").cast("double"), "seq": F.col("offset")})
    hashed = known.select(*_COLUMNS, F.xxhash64("account_id").alias(blocks.HASH))
    number = blocks.groups(shards)
    rows = hashed.withColumn(blocks.GROUP, F.pmod(F.col(blocks.HASH), F.lit(number)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(number - 1))).alias(blocks.GROUP)
    rule = F.to_json(F.struct(*[F.col(f).cast(FRAUD_RULE[f].dataType).alias(f) for f in FRAUD_RULE.names])).alias("rule")
    rules = rule_log.filter(F.col("rule_id").isNotNull()).select(every, F.col("offset").alias("seq"), rule)
    both = rows.unionByName(rules, allowMissingColumns=True)
    mode = "None" if keep_ms is None else "ProcessingTime"
    judged = blocks.pack_groups(both).groupBy("shard").transformWithState(LookBack(bucket_ms, keep_ms), blocks.BLOCK, "Append", mode)
    return blocks.unpack(judged, OUTPUT)


def detect(
    records: DataFrame,
    rule_log: DataFrame,
    root: str,
    profiles: Callable[[], DataFrame],
    trigger: Trigger = Trigger(),
    keep_ms: int = KEEP_MS,
    **tuning: int,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Dead letters, and alerts and user scores, of raw payments as they arrive. ``profiles`` is called for each batch."""

    def letters(batch: DataFrame, batch_id: int) -> None:
        found = parsing.dead_letters(parsing.parse_payments(batch))
        found.write.mode("overwrite").parquet(batch_folder(root, "dead_letters", batch_id))

    def score(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            small = (F.col("small_units") / F.lit(10.0**_SCALE)).alias("small_sum")
            touched = batch.select(F.col("account_id").alias("user_id")).distinct()
            known = profiles().join(touched, "user_id", "left_semi")
            scored = fraud.score_counted(batch.select("*", small), known).persist()
            fraud.fraud_alerts(scored).write.mode("overwrite").parquet(batch_folder(root, "alerts", batch_id))
            fraud.user_scores(scored).write.mode("overwrite").parquet(batch_folder(root, "scores", batch_id))
            scored.unpersist()
        finally:
            batch.unpersist()

    written = _start(records.writeStream.foreachBatch(letters), f"{root}/_checkpoints/letters", trigger)
    stream = counted(records, rule_log, keep_ms=None if trigger.available_now else keep_ms, **tuning)
    return written, _start_keyed(stream, "append", score, f"{root}/_checkpoints/lookback", trigger)
