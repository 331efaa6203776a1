"""Recursive exponential moving averages, exact for series of any length.

``e_1 = c_1``, ``e_t = alpha * c_t + (1 - alpha) * e_{t-1}`` with
``alpha = 2 / (span + 1)``. All averages of a call are the components of one
state vector x, also an average over the difference of two others (the MACD
signal), so a row is one affine map ``x -> A x + u`` with the same matrix A
in every row and a vector u of the row's inputs. ``x_t`` is the composition
of the maps up to row t; a series' first row has inputs of its own, and its
entry state is 0.

A per-ticker fold would put a whole ticker into one task, so the scan goes
over blocks of consecutive rows:

1. each block's maps are composed into one, ``x -> A^n x + q``. Only the
   key, the order and the inputs are read and shuffled for this, and one
   small row per block is written;
2. the block maps are scanned per series (a level more for each factor of
   ``FAN`` in the number of blocks), which gives each block its entry state;
3. the rows are exchanged once by (key, block), the entry states travelling
   among them as marker rows that sort before their block's first row. Each
   task applies its blocks' maps from there.

A DATE order needs no row numbers: a span of ``block_rows`` days holds at
most so many rows. Other orders are numbered first
(:func:`frames.number_series`). The input is read twice, whatever the number
of averages. In steps 1 and 3 a task streams over its sorted rows, doubling
over up to ``slice_rows`` of them at a time, so no block is ever held as a whole.

A NULL input makes every later value of its averages NULL, as in the plain
recurrence; NaN and infinite inputs follow floating-point arithmetic. They
are carried as flags beside the numbers, so they spoil no other average.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from candela.operators.frames import RN, changes, number_series
from candela.session import scratch_dir, workers_find_package

DEFAULT_BLOCK_ROWS = 4096
#: Blocks of one series that are scanned in one row.
FAN = 4096
#: Rows of one numpy step (``slice_rows``).
SLICE = 8192
#: Day 0 of the blocks lies before every date of a calendar; a NULL date comes before it.
FIRST_DAY = 1 << 23
BLK, ROW, ENTRY, FLAGS, INPUT = "_blk", "_row", "_entry", "_flags", "_in"
NULL, NAN, UP, DOWN = 1, 2, 4, 8


@dataclass(frozen=True)
class Leg:
    """One average: ``out`` over the column ``col``, or over the difference of two earlier averages."""

    out: str
    span: int
    col: str | None = None
    of: tuple[str, str] | None = None


@dataclass
class System:
    """Matrix form of several averages. Row: ``x = step @ x + later @ c`` (first row of a series: ``first @ c``)."""

    legs: Sequence[Leg]
    cols: list[str] = field(init=False)
    step: np.ndarray = field(init=False)
    later: np.ndarray = field(init=False)
    first: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.cols = list(dict.fromkeys(leg.col for leg in self.legs if leg.col is not None))
        k, c = len(self.legs), len(self.cols)
        self.step, self.later, self.first = np.zeros((k, k)), np.zeros((k, c)), np.zeros((k, c))
        self.place = {leg.out: i for i, leg in enumerate(self.legs)}
        if len(self.place) < k:
            raise ValueError("two averages have the same name")
        for i, leg in enumerate(self.legs):
            alpha = 2.0 / (leg.span + 1)
            if leg.of is None:
                self.later[i, self.cols.index(leg.col)] = alpha
                self.first[i, self.cols.index(leg.col)] = 1.0
            else:
                a, b = (self.place[name] for name in leg.of)
                if max(a, b) >= i:
                    raise ValueError(f"{leg.out} reads an average that comes after it")
                self.step[i] = alpha * (self.step[a] - self.step[b])
                self.later[i] = alpha * (self.later[a] - self.later[b])
                self.first[i] = self.first[a] - self.first[b]
            self.step[i, i] += 1 - alpha
        self._power: dict[int, np.ndarray] = {}

    def power(self, n: int) -> np.ndarray:
        if n not in self._power:
            if len(self._power) > 10_000:
                self._power.clear()
            self._power[n] = np.linalg.matrix_power(self.step, n)
        return self._power[n]

    def powers(self, n: int) -> np.ndarray:
        """The powers 0 to n as one array."""
        out = np.eye(len(self.step))[None]
        while len(out) <= n:
            out = np.concatenate([out, out @ (out[-1] @ self.step)])
        return out

    def from_zero(self, u: np.ndarray, at: np.ndarray) -> np.ndarray:
        """States of runs of rows that start from 0 (``at``: place of the row in its run), by doubling."""
        x, reach, power, last = u, 1, self.step, int(at.max(initial=0))
        while reach <= last:
            moved = np.nonzero(at >= reach)[0]
            more = x[moved - reach] @ power.T
            x = x.copy()
            x[moved] += more
            power, reach = power @ power, 2 * reach
        return x

    def outputs(self, x: np.ndarray, flags: np.ndarray) -> list[pa.Array]:
        """The averages with their NULLs, NaNs and infinities, from states and the flags seen so far."""
        spoiled = [self._class_of(leg, flags) for leg in self.legs]
        out = []
        for i, kind in enumerate(spoiled):
            values = x[:, i].copy()
            if kind.any():
                values[kind == UP], values[kind == DOWN] = np.inf, -np.inf
                values[(kind & NAN) > 0] = np.nan
            out.append(pa.array(values, mask=(kind & NULL) > 0))
        return out

    def _class_of(self, leg: Leg, flags: np.ndarray) -> np.ndarray:
        """0 for a finite average, else one of NULL, NAN, UP, DOWN."""
        if leg.of is None:
            seen = flags[:, self.cols.index(leg.col)]
            both = (seen & NAN > 0) | (seen & (UP | DOWN) == UP | DOWN)
            return np.where(seen & NULL > 0, NULL, np.where(both, NAN, seen & (UP | DOWN)))
        a, b = (self._class_of(self.legs[self.place[name]], flags) for name in leg.of)
        turned = np.where(b == UP, DOWN, np.where(b == DOWN, UP, b))
        nan = (a == NAN) | (b == NAN) | ((a | turned) == UP | DOWN)
        return np.where((a == NULL) | (b == NULL), NULL, np.where(nan, NAN, a | turned))


# -- streaming over sorted rows ------------------------------------------------


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _inputs(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The input columns as finite numbers, and what they were instead, as flags."""
    values = np.empty((batch.num_rows, n))
    flags = np.zeros((batch.num_rows, n), dtype=np.uint8)
    for k in range(n):
        column = batch.column(f"{INPUT}{k}")
        null = pc.is_null(column).to_numpy(zero_copy_only=False)
        c = pc.fill_null(column, 0.0).to_numpy(zero_copy_only=False)
        finite = np.isfinite(c)
        flags[:, k] = null * NULL + np.isnan(c) * NAN + (c == np.inf) * UP + (c == -np.inf) * DOWN
        values[:, k] = np.where(finite, c, 0.0)
    return values, flags


def _seen(flags: np.ndarray, start: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Flags of each row and of the rows before it in its run (``start``: place of the run's first row)."""
    out = entry.copy()
    if flags.any():
        place = np.arange(len(flags))[:, None]
        for bit in (NULL, NAN, UP, DOWN):
            last = np.maximum.accumulate(np.where(flags & bit > 0, place, -1), axis=0)
            out |= ((last >= start[:, None]) * bit).astype(np.uint8)
    return out


class Walk:
    """State of a task's walk over rows sorted by (key, block, order): the open block's state and flags."""

    def __init__(self, system: System, slice_rows: int):
        self.system = system
        self.powers = system.powers(slice_rows)
        self.key: pa.Scalar | None = None
        self.blk: pa.Scalar | None = None
        self.state, self.flags = np.zeros(len(system.legs)), np.zeros(len(system.cols), dtype=np.uint8)

    def runs(self, batch: pa.RecordBatch, key: str) -> np.ndarray:
        """Number of the block of each row: 0 is the open one, if the first row goes on with it, else 1 is the first."""
        new = changes(batch.column(key), self.key) | changes(batch.column(BLK), self.blk)
        last = batch.num_rows - 1
        self.key, self.blk = batch.column(key)[last], batch.column(BLK)[last]
        return np.cumsum(new)

    def advance(
        self, values: np.ndarray, flags: np.ndarray, run: np.ndarray, runs: int, entry: np.ndarray, entry_flags: np.ndarray, first: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """States and flags after each row and its place in its run, from the runs' entry states; the last run stays open.

        ``first`` tells the runs that begin a series.
        """
        system = self.system
        start = np.searchsorted(run, np.arange(runs))[run] if len(run) else run
        at = np.arange(len(run)) - start
        u = values @ system.later.T
        begins = (at == 0) & first[run]
        if begins.any():
            u[begins] = values[begins] @ system.first.T
        x = system.from_zero(u, at) + np.einsum("nij,nj->ni", self.powers[at + 1], entry[run])
        seen = _seen(flags, start, entry_flags[run])
        if len(run) and run[-1] == runs - 1:
            self.state, self.flags = x[-1], seen[-1]
        else:
            self.state, self.flags = entry[runs - 1], entry_flags[runs - 1]
        return x, seen, at


def summarise(batches: Iterator[pa.RecordBatch], system: System, key: str, slice_rows: int) -> Iterator[pa.RecordBatch]:
    """One row per block: its rows ``n``, its map's vector ``q`` (``qf``: as the first block of a series), its flags."""
    walk = Walk(system, slice_rows)
    k, c = len(system.legs), len(system.cols)
    rows, extra = 0, np.zeros(k)  # of the open block: its rows, and what a series' first row would add
    key_type = blk_type = None

    def handed_on(keys: list, blks: list, ns: list, qs: list, extras: list, flags: list) -> pa.RecordBatch:
        qf = [q + system.power(n - 1) @ e for q, n, e in zip(qs, ns, extras, strict=True)]
        return pa.record_batch(
            [
                pa.array(keys, key_type), pa.array(blks, blk_type), pa.array(ns, pa.int64()),
                pa.array([list(q) for q in qs], pa.list_(pa.float64())), pa.array([list(q) for q in qf], pa.list_(pa.float64())),
                pa.array([[int(x) for x in f] for f in flags], pa.list_(pa.int32())),
            ],
            names=[key, BLK, "n", "q", "qf", FLAGS],
        )

    for batch in _slices(batches, slice_rows):
        key_type, blk_type = batch.column(key).type, batch.column(BLK).type
        open_key, open_blk, open_flags, open_state = walk.key, walk.blk, walk.flags, walk.state
        run = walk.runs(batch, key)
        values, flags = _inputs(batch, c)
        runs = int(run[-1]) + 1
        entry, entry_flags = np.zeros((runs, k)), np.zeros((runs, c), dtype=np.uint8)
        entry[0], entry_flags[0] = open_state, open_flags
        x, seen, at = walk.advance(values, flags, run, runs, entry, entry_flags, np.zeros(runs, dtype=bool))
        ends = np.nonzero(np.diff(run, append=run[-1] + 1))[0]
        starts = ends - at[ends]
        ns, qs, fs = (at[ends] + 1).tolist(), list(x[ends]), list(seen[ends])
        extras = list(values[starts] @ (system.first - system.later).T)
        keys, blks = batch.column(key).take(pa.array(ends)).to_pylist(), batch.column(BLK).take(pa.array(ends)).to_pylist()
        if run[0] == 0:  # goes on with the open block
            ns[0], extras[0] = ns[0] + rows, extra
        elif rows:
            keys, blks = [open_key.as_py(), *keys], [open_blk.as_py(), *blks]
            ns, qs, extras, fs = [rows, *ns], [open_state, *qs], [extra, *extras], [open_flags, *fs]
        rows, extra = ns.pop(), extras.pop()
        keys.pop(), blks.pop(), qs.pop(), fs.pop()
        if keys:
            yield handed_on(keys, blks, ns, qs, extras, fs)
    if rows:
        yield handed_on([walk.key.as_py()], [walk.blk.as_py()], [rows], [walk.state], [extra], [walk.flags])


def apply_maps(
    batches: Iterator[pa.RecordBatch], system: System, key: str, kept: Sequence[str], slice_rows: int
) -> Iterator[pa.RecordBatch]:
    """The rows (columns ``kept``) with their averages; marker rows (``ROW`` = 0) give a block its entry state."""
    walk = Walk(system, slice_rows)
    k, c = len(system.legs), len(system.cols)
    for batch in _slices(batches, slice_rows):
        open_flags, open_state = walk.flags, walk.state
        run = walk.runs(batch, key)
        runs = int(run[-1]) + 1
        entry, entry_flags, first = np.zeros((runs, k)), np.zeros((runs, c), dtype=np.uint8), np.ones(runs, dtype=bool)
        entry[0], entry_flags[0], first[0] = open_state, open_flags, False
        is_row = batch.column(ROW).to_numpy(zero_copy_only=False) == 1
        for place in np.nonzero(~is_row)[0].tolist():
            entry[run[place]], entry_flags[run[place]] = batch.column(ENTRY)[place].as_py(), batch.column(FLAGS)[place].as_py()
            first[run[place]] = False
        rows = batch if is_row.all() else batch.filter(pa.array(is_row))
        values, flags = _inputs(rows, c)
        x, seen, _ = walk.advance(values, flags, run[is_row], runs, entry, entry_flags, first)
        columns = [rows.column(name) for name in kept] + system.outputs(x, seen)
        yield pa.record_batch(columns, names=[*kept, *[leg.out for leg in system.legs]])


# -- scan of the block maps --------------------------------------------------------

BLOCK_MAP = f"n: long, q: array<double>, qf: array<double>, {FLAGS}: array<int>"


def _block_entries(system: System, items: pa.ListArray, entry: pa.Array, flags: pa.Array) -> Iterator[list[tuple]]:
    """For every list of consecutive blocks: (block, state before it or None, flags before it, its map)."""
    for blocks, state, seen in zip(items.to_pylist(), entry.to_pylist(), flags.to_pylist(), strict=True):
        state = None if state is None else np.array(state)
        seen = np.array(seen if seen is not None else [0] * len(system.cols), dtype=np.int32)
        out = []
        for b in blocks:
            out.append((b[BLK], state, seen, b))
            state = np.array(b["qf"]) if state is None else system.power(b["n"]) @ state + np.array(b["q"])
            seen = seen | np.array(b[FLAGS], dtype=np.int32)
        yield out


def entry_states(blocks: DataFrame, system: System, key: str, fan: int) -> DataFrame:
    """(key, block, entry state, flags) of every block that has one before it in its series."""

    def enter(items: pa.Array, entry: pa.Array, flags: pa.Array) -> pa.Array:
        lists = [
            [{BLK: b, ENTRY: None if s is None else s.tolist(), FLAGS: f.tolist()} for b, s, f, _ in found]
            for found in _block_entries(system, items, entry, flags)
        ]
        return pa.array(lists, pa.list_(pa.struct([(BLK, pa.int64()), (ENTRY, pa.list_(pa.float64())), (FLAGS, pa.list_(pa.int32()))])))

    def compose(items: pa.Array) -> pa.Array:
        maps = []
        for blocks in items.to_pylist():
            q, qf, n, seen = np.zeros(len(system.legs)), None, 0, np.zeros(len(system.cols), dtype=np.int32)
            for b in blocks:
                power, add = system.power(b["n"]), np.array(b["q"])
                q, qf = power @ q + add, np.array(b["qf"]) if qf is None else power @ qf + add
                n, seen = n + b["n"], seen | np.array(b[FLAGS], dtype=np.int32)
            maps.append({"n": n, "q": q.tolist(), "qf": qf.tolist(), FLAGS: seen.tolist()})
        vector = pa.list_(pa.float64())
        return pa.array(maps, pa.struct([("n", pa.int64()), ("q", vector), ("qf", vector), (FLAGS, pa.list_(pa.int32()))]))

    group = F.floor(F.col(BLK) / fan)
    lists = blocks.groupBy(key, group.alias("_group")).agg(F.array_sort(F.collect_list(F.struct(BLK, "n", "q", "qf", FLAGS))).alias("items"))
    ends = blocks.agg(F.min(group).alias("low"), F.max(group).alias("high")).first()
    if ends["low"] == ends["high"]:  # all blocks of a series stand in one list
        entered = lists.where(F.size("items") > 1).withColumns(
            {ENTRY: F.lit(None).cast("array<double>"), FLAGS: F.lit(None).cast("array<int>")}
        )
    else:
        composed = lists.select(key, F.col("_group").alias(BLK), F.arrow_udf(compose, f"struct<{BLOCK_MAP}>")("items").alias("m"))
        above = entry_states(_written(composed.select(key, BLK, "m.*"), "ema-blocks"), system, key, fan)
        above = above.select(F.col(key).alias("_key"), F.col(BLK).alias("_at"), ENTRY, FLAGS)
        entered = lists.join(above, lists[key].eqNullSafe(above["_key"]) & (lists["_group"] == above["_at"]), "left")
    found = F.arrow_udf(enter, f"array<struct<{BLK}:long,{ENTRY}:array<double>,{FLAGS}:array<int>>>")("items", ENTRY, FLAGS)
    return entered.select(key, F.inline(found)).where(F.col(ENTRY).isNotNull())


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# -- operators ---------------------------------------------------------------------


def _block_of(df: DataFrame, key: str, order: str, block_rows: int) -> tuple[DataFrame, str | Column]:
    """The rows with their block, and what orders them within it."""
    if dict(df.dtypes)[order] == "date":
        day = F.coalesce(F.unix_date(order) + FIRST_DAY, F.lit(0))
        return df.withColumn(BLK, F.floor(day / block_rows).cast("long")), order
    numbered = number_series(df, key, order)
    return numbered.withColumn(BLK, F.floor((F.col(RN) - 1) / block_rows).cast("long")), RN


def ema_legs(
    df: DataFrame,
    legs: Sequence[Leg],
    key: str = "ticker",
    order: str = "date",
    block_rows: int = DEFAULT_BLOCK_ROWS,
    fan: int = FAN,
    slice_rows: int = SLICE,
) -> DataFrame:
    """Add several recursive EMAs per ``key`` ordered by ``order``, all in one scan.

    An output replaces a column of its name. ``(key, order)`` must be unique.
    """
    workers_find_package(df.sparkSession)
    system = System(list(legs))
    outs = [leg.out for leg in legs]
    inputs = {f"{INPUT}{i}": F.col(c).cast("double") for i, c in enumerate(system.cols)}
    rows, within = _block_of(df, key, order, block_rows)
    rows = rows.withColumns(inputs)

    narrow = rows.select(key, BLK, within, *inputs).repartition(key, BLK).sortWithinPartitions(key, BLK, within)
    fields = {f.name: f for f in df.schema.fields}
    blocks = narrow.mapInArrow(
        lambda batches: summarise(batches, system, key, slice_rows), f"`{key}`: {fields[key].dataType.simpleString()}, {BLK}: long, {BLOCK_MAP}"
    )
    entries = entry_states(_written(blocks, "ema-blocks"), system, key, fan)

    marked = rows.withColumn(ROW, F.lit(1)).unionByName(entries.withColumn(ROW, F.lit(0)), allowMissingColumns=True)
    marked = marked.repartition(key, BLK).sortWithinPartitions(key, BLK, ROW, within)
    kept = [c for c in df.columns if c not in outs]
    schema = StructType(
        [StructField(c, fields[c].dataType) for c in kept] + [StructField(c, DoubleType()) for c in outs]
    )
    return marked.mapInArrow(lambda batches: apply_maps(batches, system, key, kept, slice_rows), schema)


def ema(
    df: DataFrame,
    col: str = "close",
    span: int = 12,
    out_col: str = "ema_12",
    key: str = "ticker",
    order: str = "date",
    block_rows: int = DEFAULT_BLOCK_ROWS,
    fan: int = FAN,
) -> DataFrame:
    """Add the recursive EMA of ``col`` per ``key`` ordered by ``order``."""
    return ema_legs(df, [Leg(out_col, span, col)], key, order, block_rows, fan)


def macd_legs(col: str = "close", fast: int = 12, slow: int = 26, signal: int = 9) -> list[Leg]:
    """The averages of a MACD line: both legs, and the signal over their difference."""
    return [Leg("ema_fast", fast, col), Leg("ema_slow", slow, col), Leg("macd_signal", signal, of=("ema_fast", "ema_slow"))]


def with_macd_lines(df: DataFrame) -> DataFrame:
    """The difference of both legs and its gap to the signal, beside them."""
    rest = [c for c in df.columns if c not in ("ema_fast", "ema_slow", "macd", "macd_signal", "macd_gap")]
    macd = F.col("ema_fast") - F.col("ema_slow")
    return df.select(
        *rest, "ema_fast", "ema_slow", macd.alias("macd"), "macd_signal", (macd - F.col("macd_signal")).alias("macd_gap")
    )


def macd_ema(
    df: DataFrame,
    col: str = "close",
    fast: int = 12,
    slow: int = 26,
    signal: int = 9,
    key: str = "ticker",
    order: str = "date",
    block_rows: int = DEFAULT_BLOCK_ROWS,
    fan: int = FAN,
) -> DataFrame:
    """T3 with EMA legs: the columns of the SMA form, with recursive EMAs for both legs and the signal."""
    return with_macd_lines(ema_legs(df, macd_legs(col, fast, slow, signal), key, order, block_rows, fan))
