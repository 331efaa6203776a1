"""Incremental refresh of rolling tables after an upsert of bars (O2 -> T13, F1).

A changed bar changes the rolling values of its own row and of the
``lookback`` rows behind it in its series, and these need the ``lookback``
rows before them. So a refresh

1. groups the changed (ticker, date) of each ticker into runs of months
   that lie close together, and widens each run on both sides until it holds
   ``lookback`` rows before its first change and behind its last one (or the
   series ends). Only the ticker and date columns of these months are read;
2. reads the bars of the runs, recomputes them, and keeps the rows that have
   a changed row at most ``lookback`` rows before them (or are one);
3. reads the parts of the derived table that these rows belong to, puts them
   in, and replaces just those parts by way of a redo record.

Parts are months and ticker buckets, as in the bars table; all others keep
their files. What is read and written follows the changes, not the length
of the history. Rows with a NULL ticker or date have no place in a series
and no derived row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from candela.operators import facts, frames, indicators
from candela.session import scratch_dir, scratch_scope
from candela.sinks import parts
from candela.streaming.jobs import BATCH, BUCKET, MOST_PART_BYTES, PERIOD

#: Derived rows from bars that :func:`frames.block_once` has cut (their block columns are carried on).
Derive = Callable[[DataFrame], DataFrame]

CHANGED, MONTH, LOW, HIGH, RUN = "_changed", "_month", "_low", "_high", "_run"


@dataclass(frozen=True)
class Derived:
    """A table that follows from the bars row by row: how, and how many rows it looks back."""

    derive: Derive
    lookback: int


def silver_table() -> Derived:
    """All indicators."""
    return Derived(indicators.silver_indicators, indicators.silver_lookback())


def fact_table(dim_date: DataFrame, dim_tickers: DataFrame) -> Derived:
    """the daily fact over the indicators."""
    return Derived(
        lambda blocked: facts.fact_daily(indicators.silver_indicators(blocked), dim_date, dim_tickers),
        indicators.silver_lookback() + facts.MEASURES_LOOKBACK,
    )


def _bars(spark: SparkSession, bars_path: str) -> DataFrame:
    """Bars with a full key, with their part columns, without the load stamp's bookkeeping."""
    stored = parts.read_parts(spark, bars_path).drop(BATCH, "processed_timestamp")
    return stored.where(F.col("ticker").isNotNull() & F.col("date").isNotNull())


def _place(rows: DataFrame, target_path: str) -> DataFrame:
    bucket = parts.bucket_of(rows.sparkSession, target_path, ["ticker"])
    return rows.withColumns({PERIOD: F.date_format("date", "yyyy-MM"), BUCKET: bucket})


def _derive(bars: DataFrame, table: Derived, block_rows: int) -> DataFrame:
    return frames.drop_ghosts(table.derive(frames.block_once(bars, table.lookback, block_rows=block_rows)))


def build_derived(
    spark: SparkSession, bars_path: str, target_path: str, table: Derived, block_rows: int = frames.DEFAULT_BLOCK_ROWS
) -> None:
    """Compute the whole table from the bars table."""
    _, buckets = parts.layout(spark, bars_path)
    rows = _derive(_bars(spark, bars_path).drop(PERIOD, BUCKET), table, block_rows)
    schema = StructType([*rows.schema.fields, StructField(PERIOD, StringType()), StructField(BUCKET, LongType())])
    parts.create(spark, target_path, schema, buckets)
    parts.create_directory(spark, target_path, buckets)
    parts.replace_parts(parts.clustered(_place(rows, target_path), [PERIOD, BUCKET], 1), target_path, [PERIOD, BUCKET])


def read_derived(spark: SparkSession, target_path: str) -> DataFrame:
    return parts.read_parts(spark, target_path).drop(PERIOD, BUCKET)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _month_of(date: str = "date"):
    return F.year(date) * 12 + F.month(date) - 1


def _period_name(month: int) -> str:
    return f"{month // 12:04d}-{month % 12 + 1:02d}"


def change_runs(changed: DataFrame, margin: int) -> DataFrame:
    """(ticker, run, first and last changed date, low and high month): changes whose widened months touch are one run."""
    months = changed.groupBy("ticker", _month_of().alias(MONTH)).agg(F.min("date").alias("first"), F.max("date").alias("last"))
    of_ticker = Window.partitionBy("ticker").orderBy(MONTH)  # at most the months there are
    apart = F.col(MONTH) - F.lag(MONTH).over(of_ticker) > 2 * margin
    numbered = months.withColumn("_apart", F.coalesce(apart, F.lit(False)).cast("int"))
    numbered = numbered.withColumn(RUN, F.sum("_apart").over(of_ticker.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("ticker", RUN).agg(
        F.min("first").alias("first"), F.max("last").alias("last"),
        (F.min(MONTH) - margin).alias(LOW), (F.max(MONTH) + margin).alias(HIGH),
    )


def _in_runs(bars: DataFrame, runs: DataFrame) -> DataFrame:
    """Bars of the runs' tickers and months. The months and buckets to open are listed first, so other folders are not."""
    months = runs.select(F.explode(F.sequence(LOW, HIGH)).alias(MONTH)).distinct().collect()  # at most the months there are
    periods = [_period_name(r[MONTH]) for r in months if r[MONTH] >= 12]
    wanted = bars.where(F.col(PERIOD).isin(periods)) if periods else bars.where(F.lit(False))
    return wanted.withColumn(MONTH, _month_of()).join(
        runs, (wanted["ticker"] == runs["ticker"]) & F.col(MONTH).between(F.col(LOW), F.col(HIGH))
    ).drop(runs["ticker"])


def affected_runs(bars: DataFrame, changed: DataFrame, lookback: int, margin: int) -> DataFrame:
    """Runs that hold ``lookback`` rows before their first change and behind their last one, as far as there are any."""
    names = [r[PERIOD] for r in bars.select(PERIOD).distinct().collect()]  # the months there are, from the folders' names
    months = [int(y) * 12 + int(m) - 1 for y, m in (n.split("-") for n in names if n[:1].isdigit())]
    low, high = min(months, default=0), max(months, default=0)
    while True:
        runs = change_runs(changed, margin).withColumns({LOW: F.greatest(LOW, F.lit(low)), HIGH: F.least(HIGH, F.lit(high))})
        runs = _stored(runs, "refresh-runs")
        narrow = _in_runs(bars.select("ticker", "date", PERIOD), runs)
        sides = narrow.groupBy("ticker", RUN, LOW, HIGH).agg(
            F.sum((F.col("date") < F.col("first")).cast("int")).alias("before"), F.sum((F.col("date") > F.col("last")).cast("int")).alias("behind")
        )
        short = ((F.col("before") < lookback) & (F.col(LOW) > low)) | ((F.col("behind") < lookback) & (F.col(HIGH) < high))
        if sides.where(short).isEmpty():
            return runs
        margin *= 2


def refresh(
    spark: SparkSession, bars_path: str, target_path: str, changed: DataFrame, table: Derived, source: str,
    block_rows: int = frames.DEFAULT_BLOCK_ROWS, margin: int = 4, most_part_bytes: int = MOST_PART_BYTES,
) -> DataFrame:
    """Bring the derived table up to date with the bars whose (ticker, date) are in ``changed``.

    ``source`` names the batch of changes: run again, it publishes what it
    had computed. ``margin`` is the number of months by which runs are
    widened at first. Returns the (ticker, date) of the rows that were
    computed again, as a scratch table (see
    :func:`candela.session.scratch_scope`).
    """
    parts.finish_pending(spark, target_path)
    keys = changed.select("ticker", "date").where("ticker IS NOT NULL AND date IS NOT NULL").distinct()
    keys = _stored(keys, "refresh-changed")
    if keys.isEmpty():
        return keys
    touched = [r[BUCKET] for r in _place(keys, bars_path).select(BUCKET).distinct().collect()]  # at most the buckets
    bars = _bars(spark, bars_path).where(F.col(BUCKET).isin(touched))
    runs = affected_runs(bars, keys, table.lookback, margin)
    rows = _in_runs(bars, runs).drop(RUN, "first", "last", LOW, HIGH, MONTH, PERIOD, BUCKET)
    rows = _stored(rows, "refresh-bars")

    flags = keys.withColumn(CHANGED, F.lit(1))
    flagged = rows.select("ticker", "date").join(flags, ["ticker", "date"], "left")
    reach = table.lookback + 1
    dirty = frames.rolling(
        flagged, lambda d, w: d.withColumn("_dirty", F.max(CHANGED).over(frames.rows(w, reach))),
        lookback=table.lookback, block_rows=block_rows,
    )
    dirty = _stored(dirty.where("_dirty = 1").select("ticker", "date"), "refresh-dirty")
    fresh = _stored(_place(_derive(rows, table, block_rows).join(dirty, ["ticker", "date"], "left_semi"), target_path), "refresh-rows")

    def merged() -> DataFrame:
        places = fresh.select(PERIOD, BUCKET).distinct()
        periods = [r[PERIOD] for r in places.select(PERIOD).distinct().collect()]  # at most the months there are
        stored = parts.read_parts(spark, target_path)
        kept = stored.where(F.col(PERIOD).isin(periods)).join(F.broadcast(places), [PERIOD, BUCKET], "left_semi")
        kept = kept.join(dirty, ["ticker", "date"], "left_anti").select(stored.columns)
        return kept.unionByName(fresh.select(stored.columns))

    parts.publish(spark, target_path, [PERIOD, BUCKET], source, merged)
    places = [r[BUCKET] for r in fresh.select(BUCKET).distinct().collect()]  # at most the buckets
    parts.split_large(spark, target_path, ["ticker"], [PERIOD, BUCKET], BUCKET, places, most_part_bytes)
    return dirty


def refresh_indicators(
    spark: SparkSession, bars_path: str, target_path: str, changed: DataFrame, source: str, block_rows: int = frames.DEFAULT_BLOCK_ROWS
) -> None:
    """:func:`refresh` of the indicator table; its scratch tables are deleted."""
    with scratch_scope(spark):
        refresh(spark, bars_path, target_path, changed, silver_table(), source, block_rows)
