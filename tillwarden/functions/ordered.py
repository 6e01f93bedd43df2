"""Ordered per-key operators (running totals, look-back windows, carry-forward) that survive hot keys.

A plain ``Window.partitionBy(key)`` sends a whole key to one task, and a sliding RANGE frame re-adds
its buffer on every row. Here each key is an ordered log:

* look-back windows become a sweep: a row adds its value at its own time and takes it away just
  after its window ends, so a window value is a running total and costs O(1) per row;
* keys above a row limit are cut into cells along the order. Totals of a cell are pre-aggregated and
  added up over the cells of the key (a small table); each cell then opens with the total before it.

Rows are shuffled once, on (key, cell). Keys at or below the limit have the single cell 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scale

HOT_ROWS = 2_000_000
CELL_MS = 600_000
CELL_ROWS = 1_000_000
UNKNOWN = object()

_CELL = "_cell"
_HOT = "_hot"
_LEAD = "_lead"


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame:
    """Keys with more than ``limit`` rows: at most rows / limit of them, whatever the data."""
    limit = limit if limit is not None else scale(df.sparkSession, "hot_rows", HOT_ROWS)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit).select(*keys)


def with_hot_flag(df: DataFrame, hot: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Adds ``_hot``. The hot list is broadcast: its length is bounded by rows / limit."""
    if hot is None:
        return df.withColumn(_HOT, F.lit(False))
    renamed = hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys], F.lit(True).alias(_HOT))
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_h_{key}"))
    joined = df.join(F.broadcast(renamed), condition, "left")
    return joined.drop(*[f"_h_{k}" for k in keys]).withColumn(_HOT, F.coalesce(F.col(_HOT), F.lit(False)))


def with_cells(df: DataFrame, hot: DataFrame | None, keys: Sequence[str], position: str, width: int) -> DataFrame:
    flagged = with_hot_flag(df, hot, keys)
    return flagged.withColumn(_CELL, F.when(F.col(_HOT), F.expr(f"`{position}` div {width}")).otherwise(F.lit(0)).cast("long"))


def _earlier_cells(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(_CELL).rowsBetween(Window.unboundedPreceding, -1)


def _with_openings(celled: DataFrame, openings: DataFrame | None, keys: Sequence[str], order: Sequence[str | Column]):
    """Puts the opening row of each hot cell in front of its rows; gives the rows and their frame.

    A union needs no join key, so rows meet their opening in the one shuffle of the window.
    """
    rows = celled.drop(_HOT).withColumn(_LEAD, F.lit(1))
    if openings is None:
        plain = Window.partitionBy(*keys).orderBy(*order)
        return rows, plain.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = rows.unionByName(openings.withColumn(_LEAD, F.lit(0)), allowMissingColumns=True)
    frame = (
        Window.partitionBy(*keys, _CELL)
        .orderBy(_LEAD, *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return both, frame


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    position: str,
    measures: Sequence[str],
    width: int,
    limit: int | None = None,
    hot: DataFrame | None = UNKNOWN,
    keep: Column | None = None,
) -> DataFrame:
    """Replaces each measure by its running total per key.

    ``order`` must begin with ``position``, a whole number. ``keep`` selects the rows to return.
    """
    hot = hot_keys(df, keys, limit) if hot is UNKNOWN else hot
    celled = with_cells(df, hot, keys, position, width)
    openings = None if hot is None else _total_openings(celled, keys, measures)
    both, frame = _with_openings(celled, openings, keys, order)
    totals = both.withColumns({m: F.sum(m).over(frame) for m in measures})
    wanted = F.col(_LEAD) == 1
    return totals.filter(wanted if keep is None else wanted & keep).drop(_LEAD, _CELL)


def _total_openings(celled: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    cells = celled.filter(F.col(_HOT)).groupBy(*keys, _CELL).agg(*[F.sum(m).alias(m) for m in measures])
    return cells.select(*keys, _CELL, *[F.sum(m).over(_earlier_cells(keys)).alias(m) for m in measures])


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    position: str,
    value: str,
    width: int,
    limit: int | None = None,
    keep: Column | None = None,
) -> DataFrame:
    """Replaces ``value`` by the last non-NULL value at or before the row, per key in ``order``."""
    hot = hot_keys(df, keys, limit)
    celled = with_cells(df, hot, keys, position, width)
    openings = None if hot is None else _last_openings(celled, keys, order, value)
    both, frame = _with_openings(celled, openings, keys, order)
    filled = both.withColumn(value, F.last(value, ignorenulls=True).over(frame))
    wanted = F.col(_LEAD) == 1
    return filled.filter(wanted if keep is None else wanted & keep).drop(_LEAD, _CELL)


def _last_openings(celled: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    newest = F.max(F.when(F.col(value).isNotNull(), F.struct(*order, F.col(value).alias("_v"))))
    cells = celled.filter(F.col(_HOT)).groupBy(*keys, _CELL).agg(newest.alias("_newest"))
    before = F.last("_newest", ignorenulls=True).over(_earlier_cells(keys))["_v"]
    return cells.select(*keys, _CELL, before.alias(value))


@dataclass(frozen=True)
class LookBack:
    """Sum of ``value`` over the rows of a key with time in ``[t - width, t]`` that came so far.

    ``width`` is a number of milliseconds or the name of a column that is constant per key.
    """

    name: str
    width: int | str
    value: Column


def look_back(
    df: DataFrame,
    keys: Sequence[str],
    time_ms: str,
    seq: str,
    sums: Sequence[LookBack],
    cell_ms: int | None = None,
    limit: int | None = None,
    keep: Column | None = None,
) -> DataFrame:
    """Adds one column per look-back sum. Rows with equal time count in ``seq`` order.

    Each row yields an enter mark and, per window width, an exit mark one order step after the last
    instant that still sees it. Exit marks carry no payload. ``keep`` names the rows to return; the
    others only count.
    """
    cell_ms = cell_ms or scale(df.sparkSession, "cell_ms", CELL_MS)
    payload = [c for c in df.columns if c not in keys]
    widths = list(dict.fromkeys(s.width for s in sums))
    valued = df.withColumns({f"_v_{s.name}": s.value for s in sums})
    types = {s.name: valued.schema[f"_v_{s.name}"].dataType for s in sums}

    def end(width: int | str) -> Column:
        return F.col(time_ms) + (F.col(width) if isinstance(width, str) else F.lit(width))

    def mark(kind: int, pos: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), pos.cast("long").alias("pos"))

    marks = F.array(mark(0, F.col(time_ms)), *[mark(i + 1, end(w)) for i, w in enumerate(widths)])
    exploded = valued.withColumn("_mark", F.explode(marks))
    kind = F.col("_mark.kind")
    enter = kind == 0
    signed = []
    for s in sums:
        value = F.col(f"_v_{s.name}")
        leave = kind == widths.index(s.width) + 1
        signed.append(F.when(enter, value).when(leave, -value).otherwise(F.lit(0)).cast(types[s.name]).alias(s.name))
    moved = exploded.select(
        *keys,
        kind.alias("_kind"),
        F.col("_mark.pos").alias("_pos"),
        F.col(seq).alias("_seq"),
        *[F.when(enter, F.col(c)).alias(c) for c in payload],
        *signed,
    )
    counts = F.col("_kind") == 0
    for s in sums:
        counts = counts | (F.col(s.name) != 0)
    wanted = F.col("_kind") == 0
    totals = running_totals(
        moved.filter(counts),
        keys,
        ["_pos", "_kind", "_seq"],
        "_pos",
        [s.name for s in sums],
        cell_ms,
        hot=hot_keys(df, keys, limit),
        keep=wanted if keep is None else wanted & keep,
    )
    return totals.drop("_kind", "_pos", "_seq")


def exact_percentile(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    share: float,
    name: str,
    width: int = CELL_ROWS,
    limit: int | None = None,
) -> DataFrame:
    """Exact interpolated percentile of a whole-number column per key.

    Rows are first counted per distinct value, then ranked by running totals, so no group is held
    in memory.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    sizes = counts.groupBy(*keys).agg(F.sum("_c").alias("_size"))
    ranked = running_totals(
        counts.withColumn("_upto", F.col("_c")), keys, [value], value, ["_upto"], width, limit
    )
    target = F.lit(share) * (F.col("_size") - 1)
    low, high = F.floor(target), F.ceil(target)
    first, last = F.col("_upto") - F.col("_c"), F.col("_upto") - 1
    joined = ranked.join(sizes, list(keys)).select(
        *keys,
        "_size",
        F.when(low.between(first, last), F.col(value)).alias("_lo"),
        F.when(high.between(first, last), F.col(value)).alias("_hi"),
    )
    picked = joined.groupBy(*keys).agg(
        F.max("_size").alias("_size"), F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi")
    )
    fraction = target - F.floor(target)
    return picked.select(
        *keys, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * fraction).alias(name), F.col("_size").alias("samples")
    )
