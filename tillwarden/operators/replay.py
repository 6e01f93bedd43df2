"""Replay of reply logs through the lifecycle state machine, by composed transitions.

A reply takes each lane of the automaton to another, so replies compose like functions, and the state before each of
them is a running composition. Rows of a lifecycle meet as one array of bounded length, where the composition is a sum:
the state is one number, lane and retry counts side by side, and a reply adds what a table says. The log of a hot
lifecycle is cut into cells. Each cell is first composed for all lanes it could start from, these tables are composed
in blocks of cells, and blocks in blocks, until one is left; going down again gives each cell its starting lane. No
array grows with a lifecycle, and no row passes through Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordered import hot_keys, with_cells
from ..session import materialize, scale
from ..sources.schemas import PAYMENT_STEPS, StepDefinition
from .automaton import DIGIT, STATUSES, Automaton, automaton

#: Rows of an array that are composed one after the other before the parts are joined.
CHUNK = 64
#: Cells whose tables are composed at once.
BLOCK = 256
#: Rows of a lifecycle that are one array. The list of longer ones has at most rows / CELL entries.
CELL = 8_192

class _Tables:
    """The automaton's tables as columns. A state has the lane in its lowest bits and then a retry count for each step."""

    def __init__(self, machine: Automaton):
        self.machine = machine
        self.many = len(machine.steps)
        self.lane_bits = max(1, (len(machine.lanes) - 1).bit_length())
        self.count_bits = (62 - self.lane_bits) // self.many
        #: Rows whose retries fit the counts.
        self.most = (1 << self.count_bits) - 1
        self.mask = (1 << self.lane_bits) - 1
        lanes = [i for i in range(len(machine.lanes)) for _ in range(machine.codes)]
        more = [0 if r < 0 else 1 << (self.lane_bits + r * self.count_bits) for r in machine.retried]
        self.delta = self.table([n - lane + m for n, lane, m in zip(machine.nexts, lanes, more)], "L")
        self.writes, self.keeps = self.table(machine.writes, "L"), self.table(machine.keeps, "L")
        self.error_step, self.error_kept = self.table(machine.error_step), self.table([int(k) for k in machine.error_kept])
        self.first, self.second = self.table(machine.first_event), self.table(machine.second_event)
        self.currents = self.table(machine.currents)
        self.names = self.table([s.name for s in machine.steps])

    @staticmethod
    def table(values, suffix: str = "") -> Column:
        """A literal array. A long one is split from text, which the optimizer folds; thousands of literals are slow to plan."""
        if len(values) > 64:
            kind = "bigint" if suffix else "int"
            return F.expr(f"cast(split('{','.join(str(int(v)) for v in values)}', ',') as array<{kind}>)")
        texts = ["NULL" if v is None else f"'{v}'" if isinstance(v, str) else f"{v}{suffix}" for v in values]
        return F.expr(f"array({', '.join(texts)})")

    def code(self) -> Column:
        """Of a log row."""
        count = 4 * self.many
        code = F.when(F.col("action") == "RETRY", count).when(F.col("action") == "FORCE_COMPLETE", count + 1)
        ok, undo = (F.coalesce(c, F.lit(False)).cast("int") for c in (F.col("status") == "SUCCESS", F.col("is_compensation")))
        for i, step in enumerate(self.machine.steps):
            code = code.when(F.col("action").isNull() & (F.col("step_name") == step.name), 4 * i + 2 * ok + undo)
        return code.otherwise(self.machine.codes - 1)

    def at(self, state: Column, code: Column) -> Column:
        """Place in the tables."""
        return (state.bitwiseAND(F.lit(self.mask)) * self.machine.codes + code + 1).cast("int")

    def step(self, state: Column, code: Column) -> Column:
        return state + F.element_at(self.delta, self.at(state, code))

    def count(self, state: Column, step: Column) -> Column:
        """Retries of a step within the array."""
        return F.call_function("shiftright", state, (step * self.count_bits + self.lane_bits).cast("int")).bitwiseAND(F.lit(self.most))

    def current(self, state: Column) -> Column:
        return F.element_at(self.currents, (state.bitwiseAND(F.lit(self.mask)) + 1).cast("int"))

    def before(self, codes: Column, start: Column) -> Column:
        """States before each row and behind the last. Appending copies an array, so it is done in chunks."""
        numbers = F.sequence(F.lit(0), F.floor((F.size(codes) - 1) / CHUNK).cast("int"))
        chunks = F.transform(numbers, lambda i: F.slice(codes, i * CHUNK + 1, F.lit(CHUNK)))

        def run(chunk: Column, first: Column) -> Column:
            return F.aggregate(chunk, F.array(first), lambda acc, c: F.concat(acc, F.array(self.step(F.element_at(acc, -1), c))))

        def join(acc: Column, chunk: Column) -> Column:
            last = F.element_at(F.element_at(acc, -1), -1)
            return F.concat(acc, F.array(F.slice(run(chunk, last), F.lit(2), F.lit(CHUNK))))

        return F.flatten(F.aggregate(chunks, F.array(F.array(start)), join))


def code(machine: Automaton) -> Column:
    """The automaton's code of a log row, from ``step_name, status, is_compensation`` and ``action``."""
    return _Tables(machine).code()


def _alone(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are worked out once: a generator keeps the optimizer from copying them into lambdas."""
    packed = F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))
    return df.select("*", F.explode(packed).alias("_one")).select(*df.columns, "_one.*")


def _arrays(rows: DataFrame) -> DataFrame:
    """One row for each lifecycle and cell with its entries in order."""
    return rows.groupBy("saga_id", "_cell").agg(F.sort_array(F.collect_list(F.struct("seq", "code", "error"))).alias("rows"))


def _codes() -> Column:
    return F.transform("rows", lambda r: r["code"])


def _starting_lanes(tables: DataFrame, machine: Automaton) -> DataFrame:
    """``saga_id, _cell, lane`` from ``table``, which maps each lane that a cell could start from to the one it ends in."""
    if not (tables.agg(F.max("_cell")).first()[0] or 0):
        return tables.select("saga_id", "_cell", F.lit(machine.start_lane).alias("lane"))
    gathered = tables.groupBy("saga_id", F.expr(f"_cell div {BLOCK}").alias("_block")).agg(F.sort_array(F.collect_list(F.struct("_cell", "table"))).alias("parts"))
    gathered = materialize(gathered, "blocks")
    same = F.expr(f"sequence(0, {len(machine.lanes) - 1})")
    whole = F.aggregate("parts", same, lambda acc, p: F.transform(acc, lambda lane: F.element_at(p["table"], lane + 1)))
    above = materialize(gathered.select("saga_id", F.col("_block").alias("_cell"), whole.alias("table")), "block-tables")
    starts = _starting_lanes(above, machine).withColumnRenamed("_cell", "_block")
    lanes = F.aggregate("parts", F.array("lane"), lambda acc, p: F.concat(acc, F.array(F.element_at(p["table"], F.element_at(acc, -1) + 1))))
    placed = F.arrays_zip(F.transform("parts", lambda p: p["_cell"]).alias("_cell"), F.slice(lanes, F.lit(1), F.size("parts")).alias("lane"))
    return gathered.join(starts, ["saga_id", "_block"]).select("saga_id", F.inline(placed).alias("_cell", "lane"))


def _open_cells(cells: DataFrame, t: _Tables) -> DataFrame:
    """Cells of hot lifecycles with their starting lane and the retries counted before them."""
    lanes = F.expr(f"sequence(0L, {len(t.machine.lanes) - 1}L)")
    table = F.transform(lanes, lambda lane: F.aggregate(_codes(), lane, t.step).bitwiseAND(F.lit(t.mask)).cast("int"))
    tables = materialize(cells.select("saga_id", "_cell", table.alias("table")), "cell-tables")
    opened = cells.join(_starting_lanes(tables, t.machine), ["saga_id", "_cell"])
    ended = _alone(opened, end=F.aggregate(_codes(), F.col("lane").cast("long"), t.step))
    steps = range(t.many)
    added = ended.select("saga_id", "_cell", "lane", *[t.count(F.col("end"), F.lit(i)).alias(f"_r{i}") for i in steps])
    earlier = Window.partitionBy("saga_id").orderBy("_cell")
    so_far = earlier.rowsBetween(Window.unboundedPreceding, -1)
    base = F.array(*[F.coalesce(F.sum(f"_r{i}").over(so_far), F.lit(0)).cast("long") for i in steps])
    opening = added.select("saga_id", "_cell", "lane", base.alias("base"), (F.row_number().over(earlier) == 1).alias("is_first"))
    return cells.join(opening, ["saga_id", "_cell"])


def _marked(cells: DataFrame, t: _Tables) -> DataFrame:
    """Each cell's entries as ``marks``: with the state before them and the place in the tables."""
    traced = _alone(cells, states=t.before(_codes(), F.col("lane").cast("long")))
    marks = F.zip_with("rows", F.slice("states", F.lit(1), F.size("rows")), lambda r, s: F.struct(r["seq"].alias("seq"), r["error"].alias("error"), s.alias("state"), t.at(s, r["code"]).alias("at")))
    return _alone(traced, marks=marks, end=F.element_at("states", -1)).drop("rows", "states")


def _left(marked: DataFrame, t: _Tables) -> DataFrame:
    """What each cell leaves behind."""
    word = F.aggregate(
        "marks",
        F.when(F.col("is_first"), F.lit(t.machine.start_word)).otherwise(F.lit(0)).cast("long"),
        lambda w, m: F.element_at(t.writes, m["at"]).bitwiseOR(w.bitwiseAND(F.element_at(t.keeps, m["at"]))),
    )

    def error(i: int) -> Column:
        """NULL if no entry touched the step's error, else a struct with its new value."""
        last = F.try_element_at(F.filter("marks", lambda m: F.element_at(t.error_step, m["at"]) == i), F.lit(-1))
        return F.when(last.isNotNull(), F.struct(F.when(F.element_at(t.error_kept, last["at"]) == 1, last["error"]).alias("value")))

    counts = F.array(*[F.element_at("base", i + 1) + t.count(F.col("end"), F.lit(i)) for i in range(t.many)])
    left = {"word": word, "errors": F.array(*[error(i) for i in range(t.many)]), "counts": counts, "current": t.current(F.col("end"))}
    return _alone(marked, **left, last_seq=F.element_at("marks", -1)["seq"]).drop("marks")


def _events(marked: DataFrame, t: _Tables) -> DataFrame:
    """Lifecycle events: those of each entry, and the start before the first."""
    events, names = t.machine.events, [s.name for s in t.machine.steps]
    number = F.col("event") + 1
    own = F.element_at(t.table([e[1] if e[3] else -1 for e in events]), number)
    attempt = F.when(own >= 0, F.element_at("base", F.greatest(own, F.lit(0)) + 1) + t.count(F.col("m.state"), own) + 1).otherwise(F.lit(1))
    entries = marked.select("saga_id", "base", "is_first", F.posexplode("marks").alias("at", "m"))
    start = F.when(F.col("is_first") & (F.col("at") == 0), F.lit(1)).otherwise(F.lit(0))
    caused = F.array(start, F.element_at(t.first, F.col("m.at")), F.element_at(t.second, F.col("m.at")))
    each = entries.select("saga_id", "base", "m", F.posexplode(caused).alias("part", "event")).filter(F.col("event") > 0)
    return each.select(
        "saga_id",
        F.col("m.seq").alias("seq"),
        "part",
        F.lit("event").alias("record"),
        F.element_at(t.table([e[0] for e in events]), number).alias("event_type"),
        F.element_at(t.table([None if e[1] is None else names[e[1]] for e in events]), number).alias("step_name"),
        F.element_at(t.table([e[2] for e in events]), number).alias("status"),
        attempt.cast("int").alias("attempt"),
    )


def _merged(left: DataFrame, t: _Tables) -> DataFrame:
    """What the cells of a lifecycle leave behind together: the newest of each."""

    def newest(value: Column, there: Column) -> Column:
        return F.max(F.when(there, F.struct("_cell", value.alias("v"))))["v"]

    digits = [F.call_function("shiftright", F.col("word"), F.lit(DIGIT * i)).bitwiseAND(F.lit(7)) for i in range(t.many + 1)]
    merged = left.groupBy("saga_id").agg(
        *[newest(d, d > 0).alias(f"_d{i}") for i, d in enumerate(digits)],
        *[newest(F.col("errors")[i], F.col("errors")[i].isNotNull()).alias(f"_e{i}") for i in range(t.many)],
        *[newest(F.col(c), F.lit(True)).alias(c) for c in ("counts", "current", "last_seq")],
    )
    word = None
    for i in range(t.many + 1):
        part = F.coalesce(F.col(f"_d{i}"), F.lit(0)).cast("long") * (1 << (DIGIT * i))
        word = part if word is None else word + part
    errors = F.array(*[F.col(f"_e{i}") for i in range(t.many)])
    return merged.select("saga_id", word.alias("word"), errors.alias("errors"), "counts", "current", "last_seq")


def _states(left: DataFrame, t: _Tables) -> DataFrame:
    """Final states: a row for each step, and one for the saga at its current step."""
    statuses = t.table(STATUSES)

    def status(i: int) -> Column:
        digit = F.call_function("shiftright", F.col("word"), F.lit(DIGIT * i)).bitwiseAND(F.lit(7))
        return F.element_at(statuses, (digit + 1).cast("int"))

    def row(record: str, part: int, name: Column, own: Column, retries: Column, error: Column) -> Column:
        fields = {"part": F.lit(part), "record": F.lit(record), "step_name": name, "status": own, "retry_count": retries.cast("int"), "error_message": error}
        return F.struct(*[v.alias(k) for k, v in fields.items()])

    current, none = F.element_at(t.names, F.col("current") + 1), F.lit(None)
    steps = [
        row("step", i, F.lit(s.name), status(i), F.element_at("counts", i + 1), F.col("errors")[i]["value"]) for i, s in enumerate(t.machine.steps)
    ]
    saga = row("saga", 0, current, status(t.many), none, none.cast("string"))
    each = left.select("saga_id", F.col("last_seq").alias("seq"), status(t.many).alias("saga_status"), current.alias("current_step"), F.inline(F.array(*steps, saga)))
    return each


def replay(
    log: DataFrame, steps: tuple[StepDefinition, ...] = PAYMENT_STEPS, limit: int | None = None, width: int = CELL
) -> DataFrame:
    """Events (``record = event``) and final states (``step`` and ``saga`` rows) of every lifecycle.

    ``log`` has ``saga_id, seq, step_name, status, error_message, is_compensation`` and, for entries of
    operators, ``action`` (``RETRY`` or ``FORCE_COMPLETE``). ``seq`` numbers the entries. A filter on ``record`` leaves
    only the branch that it needs.
    """
    if "action" not in log.columns:
        log = log.withColumn("action", F.lit(None).cast("string"))
    t = _Tables(automaton(steps))
    keys = ["saga_id"]
    most = min(CELL, t.most)
    limit = min(limit or scale(log.sparkSession, "hot_rows", most), most)
    # Written once: the count of hot lifecycles and the fold both read it, and the log may be costly to derive.
    rows = materialize(log.select("saga_id", "seq", t.code().cast("short").alias("code"), F.col("error_message").alias("error")), "coded-log")
    hot = materialize(hot_keys(rows, keys, limit), "hot-sagas")
    is_hot = not hot.isEmpty()
    celled = with_cells(rows, hot if is_hot else None, keys, "seq", min(width, most))
    zero = F.array(*[F.lit(0).cast("long")] * t.many)
    cold = _arrays(celled.filter(~F.col("_hot"))).withColumns({"lane": F.lit(t.machine.start_lane), "base": zero, "is_first": F.lit(True)})
    marked = _marked(cold, t)
    events, states = _events(marked, t), _states(_left(marked, t), t)
    if is_hot:
        cells = materialize(_arrays(celled.filter(F.col("_hot"))), "cells")
        marked = _marked(_open_cells(cells, t), t)
        events = events.unionByName(_events(marked, t))
        states = states.unionByName(_states(_merged(_left(marked, t), t), t))
    both = events.unionByName(states, allowMissingColumns=True)
    return both.select("saga_id", "seq", "part", "record", "event_type", "step_name", "status", "attempt", "retry_count", "error_message", "saga_status", "current_step")


def lifecycle_events(replayed: DataFrame) -> DataFrame:
    return replayed.filter(F.col("record") == "event").select(
        "saga_id", "seq", "part", "event_type", "step_name", "status", "attempt"
    )


def step_states(replayed: DataFrame) -> DataFrame:
    """Final state of every step, with that of its saga beside it, so that the fold runs once for both."""
    return replayed.filter(F.col("record") == "step").select(
        "saga_id", F.col("part").alias("step_order"), "step_name", "status", "retry_count", "error_message", "saga_status", "current_step"
    )


def saga_states(replayed: DataFrame) -> DataFrame:
    return replayed.filter(F.col("record") == "saga").select("saga_id", "status", F.col("step_name").alias("current_step"))
