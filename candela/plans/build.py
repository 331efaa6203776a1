"""The whole pipeline in dependency order.

raw CSV -> bronze (stream, append) -> silver_cleaned (stream, load stamp,
expectations in warn mode) -> silver_ticker_indicators (batch, after
dedup) -> dim_date, dim_tickers (SCD1 merge of the change feed) ->
fact_daily (expectations) -> fact_weekly, fact_monthly,
data_quality_metrics -> views (temp views on the session).

Every stored table lives under ``root`` and is read with its declared
schema; streaming checkpoints under ``root/_checkpoints``. Streams run with ``availableNow`` so a rerun picks
up only new files; the batch stages are recomputed from silver_cleaned
(as in the reference), and all writes overwrite, so reruns are idempotent.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from candela.operators import dims, facts, indicators, quality, views
from candela.operators.dedup import dedup_bars
from candela.session import ensure_checkpoint_dir, scratch_scope
from candela.sinks import parts
from candela.sinks.tables import export, table_exists, write_table
from candela.sources.csv_bars import read_bars_stream
from candela.sources.tables import read_stored
from candela.streaming import jobs

TABLES = (
    "bronze", "silver_cleaned", "silver_ticker_indicators", "dim_date", "dim_tickers",
    "fact_daily_ticker_performance", "fact_weekly_ticker_summary", "fact_monthly_ticker_summary",
    "data_quality_metrics",
)
VIEWS = ("v_ticker_performance", "v_sector_performance", "v_technical_screening", "v_risk_metrics",
         "v_kpi_daily_market_health")


@dataclass
class BuildResult:
    paths: dict[str, str]
    silver_expectations: dict[str, int] = field(default_factory=dict)
    fact_expectations: dict[str, int] = field(default_factory=dict)


def build_all(
    spark: SparkSession,
    raw_dir: str,
    root: str,
    metadata: DataFrame,
    *,
    year_floor: int = 2022,
    strategy: str = "blocks",
    as_of=None,
    register_views: bool = True,
    dedup: bool = True,
    export_root: str | None = None,
) -> BuildResult:
    """Run every stage; returns table paths and the expectation counters of this run.

    ``strategy`` picks the window execution of every rolling stage: "blocks"
    (a ticker's rows spread over tasks) or "plain" (one task per ticker).
    ``as_of`` (a date or ISO string) anchors the date-relative views; by
    default they take the current date of the day they are read on.
    ``dedup`` keeps the newest copy per (ticker, date) before the indicators
    (one aggregate; turn off when the feed is known to be free of repeats).
    ``export_root`` copies the seven exported tables there (overwrite).
    """
    ensure_checkpoint_dir(spark)
    p = {t: os.path.join(root, t) for t in TABLES}
    with scratch_scope(spark):  # calendars and other helper tables go when the tables are written
        silver, fact, dd, dt, silver_counts, fact_counts = _build_tables(spark, raw_dir, root, p, metadata, year_floor, strategy, dedup)

    if register_views:
        monthly = spark.read.parquet(p["fact_monthly_ticker_summary"])
        views.v_ticker_performance(fact, dd, dt, as_of).createOrReplaceTempView("v_ticker_performance")
        views.v_sector_performance(fact, dd, dt, as_of).createOrReplaceTempView("v_sector_performance")
        views.v_technical_screening(fact, dt, strategy).createOrReplaceTempView("v_technical_screening")
        views.v_risk_metrics(monthly, dt, as_of).createOrReplaceTempView("v_risk_metrics")
        views.v_kpi_daily_market_health(fact, stamp=True).createOrReplaceTempView("v_kpi_daily_market_health")
    if export_root:
        names = ("silver_cleaned", "silver_ticker_indicators", "dim_tickers", "data_quality_metrics",
                 "fact_daily_ticker_performance", "fact_monthly_ticker_summary", "fact_weekly_ticker_summary")
        stored = {n: spark.read.parquet(p[n]) for n in names}
        stored["silver_cleaned"] = jobs.read_appended(spark, p["silver_cleaned"])
        stored["silver_ticker_indicators"], stored["fact_daily_ticker_performance"] = silver, fact
        export(stored, export_root, partition_by={
            "silver_cleaned": ["ticker"], "silver_ticker_indicators": ["ticker"], "fact_daily_ticker_performance": ["year"],
        })
    return BuildResult(p, silver_counts, fact_counts)


def _build_tables(
    spark: SparkSession, raw_dir: str, root: str, p: dict[str, str], metadata: DataFrame, year_floor: int, strategy: str, dedup: bool
) -> tuple:
    """Write every stored table; returns silver, daily fact and dimensions as read back, and both expectation counters."""
    ck = lambda name: os.path.join(root, "_checkpoints", name)

    # Bronze: new raw files only, one table with a folder per month (folders and files do not grow with the tickers).
    raw = read_bars_stream(spark, raw_dir)
    landed = raw.withColumn(jobs.PERIOD, jobs.period_of(raw.columns, "date"))
    jobs.run_append(landed, p["bronze"], ck("bronze"), partition_by=[jobs.PERIOD])

    # Silver landing: stream from bronze, stamp, count rule failures (rows kept).
    bronze_stream = spark.readStream.schema(landed.schema).parquet(p["bronze"])
    silver_counts = jobs.run_append_with_expectations(
        jobs.with_load_stamp(bronze_stream.select(raw.columns)), quality.silver_rules(year_floor), p["silver_cleaned"],
        ck("silver_cleaned"),
    )

    # Indicators over the deduplicated bars (duplicate dates would make row frames ambiguous).
    cleaned = jobs.read_appended(spark, p["silver_cleaned"])
    if dedup:
        cleaned = dedup_bars(cleaned, keep_sequence=True)
    silver = indicators.silver_indicators(cleaned, strategy)
    silver_schema = silver.schema
    write_table(silver, p["silver_ticker_indicators"], partition_by=["ticker"], sort_within=["date"], cluster=False)
    silver = read_stored(spark, p["silver_ticker_indicators"], silver_schema)

    # Dimensions.
    write_table(dims.dim_date(silver), p["dim_date"])
    changes = dims.dim_tickers_source(silver, metadata)
    parts.finish_table(spark, p["dim_tickers"])
    current = read_stored(spark, p["dim_tickers"], changes.schema) if table_exists(spark, p["dim_tickers"]) else None
    merged = dims.scd1_latest(changes, ["ticker_key"], ["modified_date"], target=current)
    parts.replace_table(merged, p["dim_tickers"], "dim_tickers")
    dd, dt = spark.read.parquet(p["dim_date"]), spark.read.parquet(p["dim_tickers"])

    # Facts. The daily fact keeps its ``year`` partition column, which the views filter on beside the date.
    fact = facts.fact_daily(silver, dd, dt, strategy=strategy, stamp=True).withColumn("year", F.year("date"))
    fact_schema = fact.schema
    obs = Observation("fact_expectations")
    write_table(
        fact, p["fact_daily_ticker_performance"], partition_by=["year"], sort_within=["ticker", "date"], cluster=False,
        before_write=lambda d: quality.expect_all(d, quality.FACT_RULES, "warn", observation=obs),
    )
    fact_counts = {k: int(v) for k, v in obs.get.items()}
    fact = read_stored(spark, p["fact_daily_ticker_performance"], fact_schema)
    write_table(facts.fact_weekly(fact.drop("year"), stamp=True), p["fact_weekly_ticker_summary"])
    write_table(facts.fact_monthly(fact.drop("year"), stamp=True), p["fact_monthly_ticker_summary"])
    write_table(quality.data_quality_metrics(fact, stamp=True), p["data_quality_metrics"])

    return silver, fact, dd, dt, silver_counts, fact_counts
