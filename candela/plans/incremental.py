"""The pipeline in incremental form: each run touches what the new raw files change.

raw CSV -> bars (upsert by (ticker, date); malformed rows to quarantine) ->
dimensions (new dates and tickers merged in) -> indicators and daily fact
(only rows that the changed bars reach) -> weekly and monthly facts and
daily KPIs (only groups with such a row).

The tables equal those of :func:`candela.plans.build.build_all` over the
same files. Every step replaces its parts by way of a redo record and is
repeatable, and the stream commits a batch after its last step, so a run
that stops anywhere is completed by the next one. Indicators are the rolling
ones; recursive EMAs reach back to the start of a series and are computed by
a scan (:mod:`candela.operators.ema`).
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.operators import dims, partials
from candela.session import ensure_checkpoint_dir, scratch_scope
from candela.sinks import parts
from candela.sinks.tables import table_exists
from candela.sources import csv_bars
from candela.sources.tables import read_stored
from candela.streaming import jobs, refresh, summaries


@dataclass(frozen=True)
class Tables:
    """Paths of the tables under one root."""

    root: str

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)


SUMMARIES = {"fact_weekly": partials.weekly, "fact_monthly": partials.monthly, "kpi_daily": partials.daily_health}


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of :func:`run_incremental`: bars, quarantine, dim_date, dim_tickers, silver, fact_daily or one of SUMMARIES."""
    path = Tables(root).path(name)
    if name == "bars":
        return jobs.read_bars_table(spark, path)
    if name == "quarantine":
        return jobs.read_appended(spark, path)
    if name in ("silver", "fact_daily"):
        return refresh.read_derived(spark, path)
    if name in SUMMARIES:
        return summaries.read_summary(spark, path, SUMMARIES[name]())
    return spark.read.parquet(path)


def _merge_dimension(spark: SparkSession, changes: DataFrame, path: str, keys: list[str], sequence_by: list[str]) -> None:
    parts.finish_table(spark, path)
    current = read_stored(spark, path, changes.schema) if table_exists(spark, path) else None
    parts.replace_table(dims.scd1_latest(changes, keys, sequence_by, target=current), path, path)


def _merge_dimensions(spark: SparkSession, t: Tables, batch: DataFrame, metadata: DataFrame) -> None:
    """New dates and tickers of a batch; the attributes of its tickers are brought up to date."""
    known = batch.where("ticker IS NOT NULL AND date IS NOT NULL")
    _merge_dimension(spark, dims.dim_date(known), t.path("dim_date"), ["date"], ["date_key"])
    _merge_dimension(spark, dims.dim_tickers_source(known, metadata), t.path("dim_tickers"), ["ticker_key"], ["modified_date"])


def run_incremental(
    spark: SparkSession, raw_dir: str, root: str, metadata: DataFrame, *, buckets: int = 16,
    most_part_bytes: int = jobs.MOST_PART_BYTES, margin: int = 4,
) -> None:
    """Bring all tables under ``root`` up to date with the raw files that came since the last run."""
    ensure_checkpoint_dir(spark)
    t = Tables(root)
    checkpoint = t.path("_checkpoints/bars")

    def merge(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(spark):
            _merge_dimensions(spark, t, batch, metadata)
            dd, dt = spark.read.parquet(t.path("dim_date")), spark.read.parquet(t.path("dim_tickers"))
            derived = {"silver": refresh.silver_table(), "fact_daily": refresh.fact_table(dd, dt)}
            source = f"{checkpoint}#{batch_id}"
            for name, table in derived.items():
                if parts.layout(spark, t.path(name)) is None or parts.read_parts(spark, t.path(name)) is None:
                    refresh.build_derived(spark, t.path("bars"), t.path(name), table)
                    reached = None
                else:
                    reached = refresh.refresh(
                        spark, t.path("bars"), t.path(name), batch, table, source, margin=margin, most_part_bytes=most_part_bytes
                    )
            fact = refresh.read_derived(spark, t.path("fact_daily"))
            for name, summary in SUMMARIES.items():
                _summarise(spark, fact, reached, t.path(name), summary(), source)

    landed = jobs.with_load_stamp(csv_bars.read_checked_stream(spark, raw_dir))
    good = landed.where(F.col(csv_bars.REASON).isNull()).drop(*csv_bars.CHECK_COLUMNS)
    jobs.run_upsert_bars(spark, good, t.path("bars"), checkpoint, buckets=buckets, on_merged=merge, most_part_bytes=most_part_bytes)
    held = csv_bars.read_checked_stream(spark, raw_dir)
    jobs.run_quarantine(held, t.path("quarantine"), t.path("_checkpoints/quarantine"))


def _summarise(spark: SparkSession, fact: DataFrame, reached: DataFrame | None, path: str, summary: partials.Summary, source: str) -> None:
    """All groups for a new table, else the groups with a row that the batch reached."""
    if reached is None or parts.layout(spark, path) is None:
        summaries.build_summary(spark, fact, path, summary)
    else:
        summaries.replace_groups(spark, fact, fact.join(reached, ["ticker", "date"], "left_semi"), path, summary, source)
