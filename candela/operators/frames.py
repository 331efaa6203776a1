"""Running row-frame window computations per series, plain or block-split.

Every indicator uses a bounded ``ROWS BETWEEN n-1 PRECEDING AND CURRENT ROW``
frame over one ticker's rows ordered by date. Spark evaluates a window
partition in one task, so with a plain ``partitionBy(ticker)`` the largest
ticker bounds the job. The block strategy keeps the result exact and lets
one ticker spread over many tasks:

1. number the rows of each ticker: for DATE-ordered daily rows from a tiny
   per-(ticker, year) calendar bitset that is broadcast, so the rows are
   numbered where they lie (:func:`number_daily_rows`); in any other order
   by sampled ranges of (ticker, order) and a running count over the
   partitions (:func:`number_rows`, one more shuffle);
2. cut blocks of ``block_rows`` consecutive rows and copy the last
   ``lookback`` rows of each block into the next one as ghost rows;
3. evaluate the frames over (ticker, block) ordered by row number and
   drop the ghosts.

A row's value is unchanged as long as its whole dependency chain reaches
at most ``lookback`` rows back, which the callers guarantee.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from candela.session import scratch_dir, workers_find_package


DEFAULT_BLOCK_ROWS = 4096
STRATEGIES = ("plain", "blocks")

# Helper column names (dropped before returning).
RN, BLK, GHOST, YR, OFF = "_rn", "_blk", "_ghost", "_yr", "_off"


def rows(w: WindowSpec, n: int) -> WindowSpec:
    """The last ``n`` rows up to and including the current one."""
    return w.rowsBetween(-(n - 1), 0)


# Year given to rows whose date is NULL: before every real year.
NULL_YEAR = -10000


def _join_null_safe(rows_: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Equi-join on (key, year) that keeps NULL keys (a NULL ticker is a series of its own)."""
    t = table.withColumnRenamed(key, "_k").withColumnRenamed(YR, "_y")
    cond = rows_[key].eqNullSafe(t["_k"]) & rows_[YR].eqNullSafe(t["_y"])
    return rows_.join(t, cond).drop("_k", "_y")


#: Partition that the range exchange gave a row, and its place among the rows of its key there.
PID, LOCAL = "_pid", "_local"


def changes(column: pa.Array, before: pa.Scalar | None) -> np.ndarray:
    """True where a value differs from the one before (NULLs are equal; ``before``: the value before the first, if any)."""
    first = pa.array([None if before is None else before.as_py()], type=column.type)
    left = pa.concat_arrays([first, column.slice(0, len(column) - 1)])
    differs = pc.fill_null(pc.not_equal(left, column), False).to_numpy(zero_copy_only=False)
    differs |= pc.is_null(left).to_numpy(zero_copy_only=False) != pc.is_null(column).to_numpy(zero_copy_only=False)
    if before is None:
        differs[0] = True
    return differs


def count_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Add to sorted rows their place (from 1) among the consecutive rows of their key."""
    before, count = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        place = np.arange(batch.num_rows, dtype=np.int64)
        new = changes(batch.column(key), before)
        start = np.maximum.accumulate(np.where(new, place, -1))
        local = np.where(start < 0, place + count, place - start) + 1
        before, count = batch.column(key)[batch.num_rows - 1], int(local[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local)], names=[*batch.schema.names, LOCAL])


def number_rows(df: DataFrame, key: str = "ticker", order: str = "date") -> DataFrame:
    """Add ``_rn``: 1-based position of each row within its ``key`` ordered by ``order``, a column of any sortable type.

    The rows are dealt by ranges of (key, order), whose bounds Spark samples
    so that the partitions hold about equal shares: a hot key spreads over
    as many partitions as its rows fill. They are sorted there, counted per
    key, and written once (the bounds of another run would differ). Only the
    first key of a partition can have begun in an earlier one, so the table
    of running counts has at most one row per partition and is broadcast.
    This is the only exchange of the rows. NULL order values come first.
    """
    spark = df.sparkSession
    workers_find_package(spark)
    ranged = df.repartitionByRange(key, order).sortWithinPartitions(key, order).withColumn(PID, F.spark_partition_id())
    schema = StructType([*[StructField(f.name, f.dataType) for f in df.schema.fields], StructField(PID, IntegerType()), StructField(LOCAL, LongType())])
    counted = ranged.mapInArrow(lambda batches: count_runs(batches, key), schema)
    path = scratch_dir(spark, "numbered")
    counted.write.parquet(path)
    counted = spark.read.schema(schema).parquet(path)

    here = counted.groupBy(key, PID).agg(F.max(LOCAL).alias("_n"))
    before = Window.partitionBy(key).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    begun = here.withColumn(OFF, F.sum("_n").over(before)).where(F.col(OFF) > 0)
    begun = F.broadcast(begun.select(PID, F.col(key).alias("_k"), OFF))  # at most one row per partition
    numbered = counted.join(begun, PID, "left")
    earlier = F.when(F.col(key).eqNullSafe(F.col("_k")), F.coalesce(OFF, F.lit(0))).otherwise(F.lit(0))
    return numbered.withColumn(RN, F.col(LOCAL) + earlier).select(*df.columns, RN)


# Day-of-year slots as bits: 6 x 64 = 384 >= 366.
_WORDS = 6


def number_daily_rows(df: DataFrame, key: str = "ticker", date_col: str = "date") -> DataFrame:
    """``_rn`` for daily rows (one row per (key, date)) without shuffling the rows.

    A per-(key, year) calendar records which days of the year have a row as
    a 366-bit set in six BIGINT words (``bit_or``: a hash aggregate with
    map-side partial aggregation and fixed 48-byte state). A row's number
    is the running count of earlier years plus the number of set bits
    before its own day. When the calendar is small enough to broadcast, the
    rows are numbered where they are, with no exchange; otherwise the join
    is a sort-merge join, which moves the rows once more. The calendar is written once as
    a table, so the broadcast decision is Spark's own size check on real file
    statistics. Writing it is a job that reads ``df`` once more: give a stored
    table, not a long lineage. The calendar stays in the scratch folder.
    """
    # A NULL date gets day 0 of a sentinel year before every real year, so it
    # is numbered first in its series, as an ascending window orders it.
    d = F.coalesce(F.dayofyear(date_col) - 1, F.lit(0))
    word, bit = F.floor(d / 64), (d % 64).cast("int")
    year = F.coalesce(F.year(date_col), F.lit(NULL_YEAR))
    one = F.lit(1).cast("bigint")

    def shl(c, n):
        return F.call_function("shiftleft", c, n)

    words = [f"_cw{i}" for i in range(_WORDS)]
    cal = df.groupBy(key, year.alias(YR)).agg(
        *[F.coalesce(F.bit_or(F.when(word == i, shl(one, bit))), F.lit(0).cast("bigint")).alias(w)
          for i, w in enumerate(words)]
    )
    size = sum((F.bit_count(F.col(w)) for w in words), F.lit(0))
    before = Window.partitionBy(key).orderBy(YR).rowsBetween(Window.unboundedPreceding, -1)
    cal = cal.withColumn(OFF, F.coalesce(F.sum(size).over(before), F.lit(0)).cast("bigint"))
    # Small (one row per ticker and year): written once under the shared
    # checkpoint folder and read back, so the planner sees its real size and
    # broadcasts it by its own threshold (sort-merge join beyond it).
    spark = df.sparkSession
    path = scratch_dir(spark, "calendar")
    cal.write.parquet(path)
    cal = spark.read.parquet(path)
    tagged = df.withColumn(YR, year)
    j = _join_null_safe(tagged, cal, key)
    below = F.bitwise_not(shl(F.lit(-1).cast("bigint"), bit))  # low `bit` bits set, no overflow
    rank = sum(
        (F.when(word > i, F.bit_count(F.col(w))).when(word == i, F.bit_count(F.col(w).bitwiseAND(below))).otherwise(0)
         for i, w in enumerate(words)),
        F.lit(0),
    )
    return j.withColumn(RN, F.col(OFF) + rank + 1).drop(YR, OFF, *words)


def number_series(df: DataFrame, key: str = "ticker", order: str = "date") -> DataFrame:
    """``_rn`` per series: the calendar-bitset numbering for a DATE order, else the one by sampled ranges."""
    if dict(df.dtypes).get(order) == "date":
        return number_daily_rows(df, key, order)
    return number_rows(df, key, order)


def with_blocks(numbered: DataFrame, lookback: int, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Assign ``_blk`` and replicate each block's last ``lookback`` rows into the next as ghosts."""
    if not 0 <= lookback < block_rows:
        raise ValueError(f"block_rows={block_rows} must exceed the look-back of {lookback} rows: pass a larger block_rows")
    idx = F.col(RN) - 1
    own = F.floor(idx / block_rows)
    tail = (idx % block_rows) >= (block_rows - lookback)
    targets = F.when(tail, F.array(own, own + 1)).otherwise(F.array(own))
    return (
        numbered.withColumn("_own", own)
        .withColumn(BLK, F.explode(targets))
        .withColumn(GHOST, F.col(BLK) != F.col("_own"))
        .drop("_own")
    )


def rolling(
    df: DataFrame,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    *,
    key: str = "ticker",
    order: str = "date",
    lookback: int,
    strategy: str = "blocks",
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """Apply ``compute(frame, w)`` where ``w`` orders each series' rows.

    ``compute`` must only use ``w`` (optionally with bounded row frames
    reaching at most ``lookback`` rows back, including chained levels).
    ``(key, order)`` must be unique (deduplicate first): ties would make
    row frames, and so the results, depend on row order.

    A frame that :func:`block_once` cut carries its blocks: ``compute`` runs
    on them as they are, and the caller drops the ghosts at the end of the
    chain (:func:`drop_ghosts`).
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if GHOST in df.columns:
        return compute(df, Window.partitionBy(key, BLK).orderBy(RN))
    if strategy == "plain":
        return compute(df, Window.partitionBy(key).orderBy(order))
    cols = df.columns
    blocked = with_blocks(number_series(df, key, order), lookback, block_rows)
    w = Window.partitionBy(key, BLK).orderBy(RN)
    out = compute(blocked, w)
    extra = [c for c in out.columns if c not in cols and c not in (RN, BLK, GHOST)]
    return out.where(~F.col(GHOST)).select(*cols, *extra)


def fitting_block_rows(lookback: int, block_rows: int | None = None) -> int:
    """The asked block size (a block must be longer than the look-back), else 4,096 rows or four look-backs."""
    if block_rows is None:
        return DEFAULT_BLOCK_ROWS if lookback < DEFAULT_BLOCK_ROWS else 4 * lookback
    if lookback >= block_rows:
        raise ValueError(f"block_rows={block_rows} must exceed the look-back of {lookback} rows: pass a larger block_rows")
    return block_rows


CARRIED = (RN, BLK, GHOST)


def block_once(
    df: DataFrame, lookback: int, key: str = "ticker", order: str = "date", block_rows: int = DEFAULT_BLOCK_ROWS
) -> DataFrame:
    """Number and cut the rows once for a whole chain of rolling stages.

    ``lookback`` is the sum of the stages' look-backs: a ghost row of the
    last stage must itself have complete inputs from the stages before.
    """
    return with_blocks(number_series(df, key, order), lookback, block_rows)


def carried(df: DataFrame) -> list[str]:
    """The block columns that a stage has to pass on (none for a plain frame)."""
    return [c for c in CARRIED if c in df.columns]


def drop_ghosts(df: DataFrame) -> DataFrame:
    """End of a chain over :func:`block_once`: the series' own rows, without the block columns."""
    return df.where(~F.col(GHOST)).drop(*CARRIED) if GHOST in df.columns else df
