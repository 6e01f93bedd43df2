"""Counts the rows that a windowed stream drops because they come too late.

The stream observes, beside its work, how many rows each batch has per window. A listener gets that with the progress of
the batch. Spark drops rows whose window had ended by the watermark of the batch before, so these are counted.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

#: Windows that a batch may touch for its count to be exact.
WINDOWS = 10_000


class LateCounter(StreamingQueryListener):
    """``batches`` has a row for each batch: ``batch_id, read, late, exact``; ``publish`` gets each as well.

    One counter is for one run of one query; after a restart the first batch with rows is judged by the watermark that
    the run began with, as the query itself does.
    """

    def __init__(self, publish: Callable[[dict], None] | None = None, windows: int = WINDOWS):
        self.name = f"late_{uuid.uuid4().hex}"
        self.publish, self.windows = publish, windows
        self.batches: list[dict] = []
        self.before = None
        self.width = 0

    def start(self, spark: SparkSession) -> LateCounter:
        spark.streams.addListener(self)
        return self

    def stop(self, spark: SparkSession) -> None:
        spark.streams.removeListener(self)

    def observed(self, df: DataFrame, time: str, width_ms: int) -> DataFrame:
        self.width = width_ms
        window = F.floor(F.unix_millis(time) / width_ms).cast("double")
        return df.observe(self.name, F.count(time).alias("read"), F.histogram_numeric(window, F.lit(self.windows)).alias("windows"))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = progress.observedMetrics.get(self.name)
        mark = progress.eventTime.get("watermark")
        if found is None and self.before is None:
            return
        mark = None if mark is None else datetime.fromisoformat(mark.replace("Z", "+00:00")).timestamp() * 1000
        if found is not None:
            bins = found["windows"] or []
            limit = self.before if self.before is not None else mark
            late = 0 if limit is None else sum(round(b["y"]) for b in bins if (round(b["x"]) + 1) * self.width <= limit)
            self.batches.append({"batch_id": progress.batchId, "read": found["read"], "late": late, "exact": len(bins) < self.windows})
            if self.publish is not None:
                self.publish(self.batches[-1])
        self.before = mark

    @property
    def late(self) -> int:
        return sum(b["late"] for b in self.batches)

    @property
    def read(self) -> int:
        return sum(b["read"] for b in self.batches)
