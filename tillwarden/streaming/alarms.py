"""Alarms while data arrives: quiet, pending, firing, resolved, over event time.

Events are first counted per step of the grid, incrementally, and a count is final when the watermark passes its step.
The counts of the steps go on to one small state machine for each alarm, so what it handles does not grow with the
events. The rate at an instant is that of the steps before it; an alarm is pending from the first instant above its
threshold, and fires once it has been above for the hold.
"""

from __future__ import annotations

import datetime
import sys
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.monitoring import MINUTE
from .jobs import WATERMARK, Trigger, _start_keyed, batch_folder

# Processors travel with the job: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTPUT = "alarm string, state string, at timestamp, pending_since timestamp, fired_at timestamp, last_true_at timestamp"


@dataclass(frozen=True)
class Alarm:
    """Fires when more than ``threshold`` events a second came over ``window_seconds``, for ``hold_seconds``."""

    name: str
    threshold: float
    window_seconds: int = 300
    hold_seconds: int = 300


def _time(slot: int, step: int) -> datetime.datetime:
    return datetime.datetime.fromtimestamp(slot * step, datetime.timezone.utc)


class AlarmState(StatefulProcessor):
    """Goes through the grid from count to count. Between two counts only as many instants matter as a window has steps."""

    def __init__(self, alarms: dict[str, Alarm], step: int):
        self.alarms, self.step = alarms, step

    def init(self, handle: StatefulProcessorHandle) -> None:
        # the slots in the window with their counts, the next instant to judge, the first true one and the last
        self.state = handle.getValueState("alarm", "slots array<long>, counts array<long>, next long, since long, last long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        alarm = self.alarms[key[0]]
        width, hold = alarm.window_seconds // self.step, alarm.hold_seconds // self.step
        found = self.state.get() if self.state.exists() else ([], [], None, None, None)
        window, upcoming, since, last = dict(zip(found[0], found[1])), *found[2:]
        fresh = sorted((r.slot, r.n) for r in rows)
        if not fresh:
            return

        def row(state: str, at: int) -> Row:
            fired = since + hold if last - since >= hold else None
            named = {"at": at, "pending_since": since, "fired_at": fired, "last_true_at": last}
            return Row(alarm=alarm.name, state=state, **{k: None if v is None else _time(v, self.step) for k, v in named.items()})

        def judge(until: int) -> Iterator[Row]:
            """Instants up to one, which see the steps before them."""
            nonlocal upcoming, since, last
            while upcoming is not None and upcoming <= until:
                for slot in [s for s in window if s < upcoming - width]:
                    del window[slot]
                if not window:
                    if since is not None:
                        yield row("resolved", upcoming)
                        since = last = None
                    upcoming = None
                    break
                total = sum(n for s, n in window.items() if s < upcoming)
                if total / alarm.window_seconds > alarm.threshold:
                    begun = since is None
                    since, last = upcoming if begun else since, upcoming
                    if last - since == hold:
                        yield row("firing", upcoming)
                    elif begun:
                        yield row("pending", upcoming)
                elif since is not None:
                    yield row("resolved", upcoming)
                    since = last = None
                upcoming += 1

        for slot, n in fresh:
            yield from judge(slot)
            if n:
                window[slot] = window.get(slot, 0) + n
                upcoming = slot + 1 if upcoming is None else upcoming
        # The instant after the last step is known: later steps do not count for it.
        yield from judge(fresh[-1][0] + 1)
        slots = sorted(window)
        self.state.update((slots, [window[s] for s in slots], upcoming, since, last))

    def close(self) -> None:
        pass


def watch(events: DataFrame, root: str, alarms: list[Alarm], step: int = MINUTE, trigger: Trigger = Trigger()) -> StreamingQuery:
    """Writes each change of an alarm's state.

    ``events`` has ``alarm``, the name of the alarm that it counts for, ``at``, and ``counts``: false for the ticks of a
    clock, which move time on when nothing happens.
    """
    known = {a.name: a for a in alarms}
    timed = events.filter(F.col("alarm").isin(list(known))).withWatermark("at", WATERMARK)
    slots = timed.groupBy("alarm", F.window("at", f"{step} seconds").alias("w")).agg(F.count_if("counts").alias("n"))
    counted = slots.select("alarm", F.expr(f"unix_seconds(w.start) div {step}").alias("slot"), "n")
    changes = counted.groupBy("alarm").transformWithState(AlarmState(known, step), OUTPUT, "Append", "None")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(root, "alarms", batch_id))

    return _start_keyed(changes, "append", write, f"{root}/_checkpoints/alarms", trigger)


def spans(spark: SparkSession, root: str) -> DataFrame:
    """The resolved times in which an alarm has fired, in the form of the batch alarms."""
    changes = spark.read.parquet(f"{root}/alarms").filter("state = 'resolved' AND fired_at IS NOT NULL")
    return changes.select("alarm", "pending_since", "fired_at", "last_true_at")
