"""Registry entries for file-roundtrip and streaming jobs.

Each query stages rows of the test tables as file drops under the shared
checkpoint root, runs the library's job over them (two incremental runs
where the job is incremental) and reads the job's output back. The result
must equal a plain SQL reading of the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.checks.oracle import BARS, bars_select, r4, with_
from candela.checks.queries import Star, check_stamp, norm
from candela.operators import dims, partials
from candela.plans import incremental
from candela.schema import BAR_COLUMNS
from candela.session import scratch_dir
from candela.sinks.tables import export, write_table
from candela.sources.csv_bars import read_bars_csv, read_bars_stream, read_checked_stream, write_bars_csv
from candela.sources.metadata import empty_ticker_metadata, read_ticker_metadata
from candela.sources.staging import (
    EARLY, LATE, broken_bars, broken_events, null_users, stale_copies, stamped, with_symbols, write_malformed_csv,
)
from candela.sources.tables import read_stored, read_table
from candela.sources.tpch_bars import load_bars, load_ticker_metadata
from candela.streaming import counters, jobs, late_dedup, refresh, summaries

# Fixed values used to split test tables into two file drops.
BAR_SPLIT_YEAR = 1998
LISTED = ["NATION_1", "NATION_10", "NATION_7", "NO SUCH TICKER"]
SUMMARY_CUT = "1998-05-14"
CORRECTED_MONTHS = ("1996-03", "1998-11")
EVENT_SPLIT = "2024-01-16 00:00:00"

# Expectations checked on the event stream.
EVENT_RULES = [
    ("valid_user", "user_id IS NOT NULL"),
    ("positive_value", "value > 0"),
    ("not_error", "event_type <> 'error'"),
    ("value_under_300", "value < 300"),
]


def _split(df: DataFrame, cond) -> tuple[DataFrame, DataFrame]:
    c = F.coalesce(cond, F.lit(False))
    return df.where(c), df.where(~c)


def _staged_bars(spark, sf) -> DataFrame:
    """Bars of the line items, formed once and stored: for jobs that take several drops and dimensions from them."""
    path = scratch_dir(spark, "staged-bars")
    bars = load_bars(spark, sf)
    bars.write.parquet(path)
    return read_stored(spark, path, bars.schema)


def _bar_drops(bars: DataFrame):
    return _split(bars, F.year("date") < BAR_SPLIT_YEAR)


def _event_drops(events: DataFrame, newer_first: bool = False):
    early, late = _split(events, F.col("ts") < F.lit(EVENT_SPLIT).cast("timestamp_ntz"))
    return (late, early) if newer_first else (early, late)


def q_ingest_bars(spark, sf):
    """Two CSV drops ingested incrementally into a ticker-partitioned table."""
    raw, sink, ckpt = (scratch_dir(spark, n) for n in ("raw", "bronze", "bronze-ckpt"))
    first, second = _bar_drops(load_bars(spark, sf))
    for drop in (first, second):
        write_bars_csv(drop, raw)
        jobs.run_append(read_bars_stream(spark, raw), sink, ckpt, partition_by=["ticker"])
    return norm(read_stored(spark, sink, first.schema).select(*BAR_COLUMNS))


def q_ingest_symbols(spark, sf):
    """Futures, index, '+' and all-digit symbols, from folders named by the source and by Spark."""
    raw, spark_raw, sink, ckpt = (scratch_dir(spark, n) for n in ("sym-raw", "sym-spark", "sym-sink", "sym-ckpt"))
    bars = with_symbols(load_bars(spark, sf))
    write_bars_csv(bars, raw)
    jobs.run_append(read_bars_stream(spark, raw), sink, ckpt, partition_by=["ticker"])
    # what the table holds is written once more as drops and read back: names survive both ways
    write_bars_csv(read_stored(spark, sink, bars.schema), spark_raw)
    names = [r["ticker"] for r in bars.select("ticker").distinct().collect()]
    return norm(read_bars_csv(spark, spark_raw, tickers=names).select(*BAR_COLUMNS))


def q_ingest_listed(spark, sf):
    """S3: a ticker list narrows the scan to its folders."""
    raw = scratch_dir(spark, "listed-raw")
    write_bars_csv(load_bars(spark, sf), raw)
    return norm(read_bars_csv(spark, raw, tickers=LISTED).select(*BAR_COLUMNS))


def q_ingest_quarantine(spark, sf):
    """Good rows land as they are; malformed ones are held back with their reason, over two incremental runs."""
    raw, sink, bad, ckpt = (scratch_dir(spark, n) for n in ("bad-raw", "bad-sink", "bad-rows", "bad-ckpt"))
    for drop in _bar_drops(load_bars(spark, sf)):
        write_malformed_csv(drop, raw)
        jobs.run_ingest_with_quarantine(read_checked_stream(spark, raw), sink, bad, ckpt)
    good = jobs.read_appended(spark, sink).select(*BAR_COLUMNS, F.lit(None).cast("string").alias("reason"), F.lit(1).alias("n_rows"))
    held = jobs.read_appended(spark, bad).groupBy("ticker", "reason").agg(F.count(F.lit(1)).alias("n_rows"))
    return norm(good.unionByName(held, allowMissingColumns=True))


def q_metadata_records(spark, sf):
    """Metadata as records of a JSON file source, joined to the tickers of the bars."""
    path = scratch_dir(spark, "metadata")
    load_ticker_metadata(spark, sf).write.json(path)
    return norm(dims.dim_tickers_source(load_bars(spark, sf), read_ticker_metadata(spark, path, "json"), modified=check_stamp()))


def q_metadata_empty(spark, sf):
    """An empty, typed metadata relation gives every ticker the defaults."""
    return norm(dims.dim_tickers_source(load_bars(spark, sf), empty_ticker_metadata(spark), modified=check_stamp()))


def q_view_of_table(spark, sf):
    """A stored table behind a temporary view, aggregated by SQL."""
    path, name = scratch_dir(spark, "view-bars"), "candela_check_bars"
    write_table(load_bars(spark, sf), path)
    spark.read.parquet(path).createOrReplaceTempView(name)
    return spark.sql(f"SELECT ticker, count(*) AS bars, min(date) AS first_date, sum(volume) AS volume FROM {name} GROUP BY ticker")


def q_keys_and_stamps(spark, sf):
    """Per year, distinct hash keys equal distinct tickers, and the load stamp is the time of the run."""
    bars = jobs.with_load_stamp(load_bars(spark, sf)).withColumn("key", F.xxhash64("ticker"))
    stamped_now = F.abs(F.unix_timestamp("processed_timestamp") - F.unix_timestamp(F.now())) < 60
    return bars.groupBy(F.year("date").cast("bigint").alias("year")).agg(
        F.countDistinct("key").alias("keys"), F.countDistinct("ticker").alias("tickers"), F.min(stamped_now).alias("stamped"),
    )


def q_union_bars(spark, sf):
    """Two raw roots streamed separately and unioned by name."""
    raw_a, raw_b, sink, ckpt = (scratch_dir(spark, n) for n in ("raw-a", "raw-b", "union", "union-ckpt"))
    bars = load_bars(spark, sf)
    part_a, part_b = _split(bars, F.col("ticker") < F.lit("M"))
    write_bars_csv(part_a, raw_a)
    write_bars_csv(part_b, raw_b)
    stream = jobs.union_streams(read_bars_stream(spark, raw_a), read_bars_stream(spark, raw_b))
    jobs.run_append(stream, sink, ckpt, partition_by=["ticker"])
    return norm(read_stored(spark, sink, bars.schema).select(*BAR_COLUMNS))


def q_export_roundtrip(spark, sf):
    """Export (overwrite, partitioned by ticker) twice, read back once."""
    root = scratch_dir(spark, "export")
    tables = {"silver_cleaned": stamped(load_bars(spark, sf), LATE)}
    for _ in range(2):
        paths = export(tables, root, partition_by={"silver_cleaned": ["ticker"]})
    return norm(read_stored(spark, paths["silver_cleaned"], tables["silver_cleaned"].schema).select(*BAR_COLUMNS))


def _upserted(spark, bars: DataFrame) -> DataFrame:
    target, raw, ckpt = (scratch_dir(spark, n) for n in ("upsert", "upsert-raw", "upsert-ckpt"))
    jobs.create_bars_table(stale_copies(bars), target, buckets=2)
    for drop in _bar_drops(bars):
        write_bars_csv(drop, raw)
        jobs.run_upsert_bars(spark, jobs.with_load_stamp(read_bars_stream(spark, raw)), target, ckpt)
    return jobs.read_bars_table(spark, target)


def q_upsert_bars(spark, sf):
    """O2: stale copies in the table, corrected bars arrive as two CSV drops and are merged."""
    return norm(_upserted(spark, load_bars(spark, sf)).select(*BAR_COLUMNS))


def q_upsert_null_keys(spark, sf):
    """O2 with NULL tickers and dates: rows without a full key are all kept, the others merged."""
    return norm(_upserted(spark, broken_bars(load_bars(spark, sf))).select(*BAR_COLUMNS))


def _refreshed(spark, sf, table_of):
    """A derived table built from bars of which two months hold stale copies and two more days are missing, refreshed after upserts."""
    bars = _staged_bars(spark, sf)
    month = F.date_format("date", "yyyy-MM")
    late = month.isin(*CORRECTED_MONTHS)
    missing = late & F.dayofmonth("date").isin(11, 12)
    base, target, raw, ckpt = (scratch_dir(spark, n) for n in ("rf-bars", "rf-target", "rf-raw", "rf-ckpt"))
    first = stamped(bars.where(~late), EARLY).unionByName(stale_copies(bars.where(late & ~missing)))
    jobs.create_bars_table(first, base, buckets=2)
    table = table_of(bars)
    refresh.build_derived(spark, base, target, table)
    for name in CORRECTED_MONTHS:
        write_bars_csv(bars.where(month == name), raw)
        jobs.run_upsert_bars(
            spark, jobs.with_load_stamp(read_bars_stream(spark, raw)), base, ckpt,
            on_merged=lambda batch, k: refresh.refresh(spark, base, target, batch, table, f"{ckpt}#{k}"),
        )
    return refresh.read_derived(spark, target)


def q_refresh_indicators(spark, sf):
    """O2 -> T13: corrected and added bars are upserted; only the rows that they reach are computed again."""
    return norm(_refreshed(spark, sf, lambda bars: refresh.silver_table()))


def q_refresh_fact(spark, sf):
    """O2 -> F1: the same for the daily fact."""
    meta = load_ticker_metadata(spark, sf)
    tables = lambda bars: refresh.fact_table(dims.dim_date(bars), dims.dim_tickers_source(bars, meta, modified=check_stamp()))
    return norm(_refreshed(spark, sf, tables))


def _incremental(spark, sf, name):
    """A table of the incremental pipeline: all bars with some days stale or missing, then two drops that correct them."""
    raw, root = (scratch_dir(spark, n) for n in ("inc-raw", "inc-root"))
    bars, meta = _staged_bars(spark, sf), load_ticker_metadata(spark, sf)
    late = F.date_format("date", "yyyy-MM").isin(*CORRECTED_MONTHS)
    missing = late & F.dayofmonth("date").isin(11, 12)
    stale = stale_copies(bars.where(late & ~missing)).drop("processed_timestamp")
    for drop in (bars.where(~late).unionByName(stale), bars.where(late & missing), bars.where(late & ~missing)):
        write_bars_csv(drop, raw)
        incremental.run_incremental(spark, raw, root, meta, buckets=2)
    return norm(incremental.read(spark, root, name))


def q_incremental_monthly(spark, sf):
    """O2 -> T13 -> F1 -> F4: the monthly fact of the incremental pipeline."""
    return _incremental(spark, sf, "fact_monthly")


def _merged_summary(spark, sf, summary):
    """A summary merged from two drops of daily rows; the cut lies inside weeks, months and (by ticker) inside a day."""
    landing, target, ckpt = (scratch_dir(spark, n) for n in ("sum-land", "sum-target", "sum-ckpt"))
    fact = Star(spark, sf).fact
    cut = F.lit(SUMMARY_CUT).cast("date")
    early = (F.col("date") < cut) | ((F.col("date") == cut) & (F.xxhash64("ticker") % 2 == 0))
    for drop in _split(fact, early):
        drop.write.mode("append").parquet(landing)
        summaries.run_merge_summaries(spark, spark.readStream.schema(fact.schema).parquet(landing), {target: summary}, ckpt)
    return norm(summaries.read_summary(spark, target, summary))


def q_fact_weekly_merged(spark, sf):
    """F3 by merging the partial states of two drops."""
    return _merged_summary(spark, sf, partials.weekly())


def q_fact_monthly_merged(spark, sf):
    """F4 by merging the partial states of two drops."""
    return _merged_summary(spark, sf, partials.monthly())


def q_kpi_merged(spark, sf):
    """V5 by merging the partial states of two drops that share a day."""
    return _merged_summary(spark, sf, partials.daily_health())


def q_distinct_tickers_monthly(spark, sf):
    """Q3 / V5: exact distinct tickers per month from the daily bitmaps of two drops with growing ids."""
    ids, daily = None, None
    for drop in _bar_drops(with_symbols(load_bars(spark, sf))):
        ids = partials.dense_ids(drop, ids)
        new = partials.ticker_bitmaps(drop, ids, ["date"])
        daily = new if daily is None else daily.unionByName(new)
    month = {"year": F.year("date").cast("bigint"), "month": F.month("date").cast("bigint")}
    return partials.distinct_tickers(partials.merge_bitmaps(daily, month), list(month))


def _stage_events(spark, events: DataFrame, landing: str, drop: DataFrame, first: bool) -> DataFrame:
    drop.write.mode("overwrite" if first else "append").parquet(landing)
    return spark.readStream.schema(events.schema).parquet(landing)


def q_stream_incremental_append(spark, sf):
    """Two parquet drops of events appended by two availableNow runs."""
    landing, sink, ckpt = (scratch_dir(spark, n) for n in ("ev-land", "ev-sink", "ev-ckpt"))
    events = read_table(spark, sf, "events")
    for i, drop in enumerate(_event_drops(events)):
        stream = _stage_events(spark, events, landing, drop, i == 0)
        jobs.run_append(stream, sink, ckpt)
    return norm(spark.read.parquet(sink))


def q_stream_union(spark, sf):
    """Two event streams (by event type) unioned into one sink."""
    la, lb, sink, ckpt = (scratch_dir(spark, n) for n in ("ev-a", "ev-b", "ev-union", "ev-union-ckpt"))
    events = read_table(spark, sf, "events")
    a, b = _split(events, F.col("event_type").isin("click", "view"))
    sa = _stage_events(spark, events, la, a, True)
    sb = _stage_events(spark, events, lb, b, True)
    jobs.run_append(jobs.union_streams(sa, sb), sink, ckpt)
    return norm(spark.read.parquet(sink))


def q_stream_expect(spark, sf):
    """Rule failures counted per micro-batch (one file each) over two runs; rows are kept, counts are stored."""
    landing, sink, ckpt = (scratch_dir(spark, n) for n in ("ex-land", "ex-sink", "ex-ckpt"))
    events = broken_events(read_table(spark, sf, "events"))
    for i, drop in enumerate(_event_drops(events)):
        _stage_events(spark, events, landing, drop.repartition(3, "event_id"), i == 0)
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(landing)
        jobs.run_append_with_expectations(stream, EVENT_RULES, sink, ckpt)
    totals = jobs.expectation_counts(spark, sink)
    kept = jobs.read_appended(spark, sink).count()
    rows = [(n, e, totals.get(n, 0), kept) for n, e in EVENT_RULES]
    return spark.createDataFrame(rows, "rule STRING, expectation STRING, failed_records BIGINT, total_records BIGINT")


def q_stream_dedup(spark, sf):
    """O1 (stream): the second drop re-delivers the newer half of the events and brings the older half, late.

    The first drop lacks a part of the older events; the watermark delay (40
    days) exceeds their lateness, so the late first copies stay and the
    re-delivered ones go.
    """
    landing, sink, ckpt = (scratch_dir(spark, n) for n in ("dd-land", "dd-sink", "dd-ckpt"))
    events = read_table(spark, sf, "events")
    early, late = _event_drops(events)
    held, rest = _split(early, F.col("event_id") % 3 == 0)
    for i, drop in enumerate((late.unionByName(rest), late.unionByName(held))):
        stream = _stage_events(spark, events, landing, drop, i == 0)
        jobs.run_append(jobs.dedup_stream(stream, ["event_id"], "ts", "40 days"), sink, ckpt)
    return norm(spark.read.parquet(sink))


def q_stream_dedup_late(spark, sf):
    """O1 without a watermark: the newer half first, then the older half with all copies of the newer one; nothing is lost."""
    landing, sink, ckpt = (scratch_dir(spark, n) for n in ("dl-land", "dl-sink", "dl-ckpt"))
    events = read_table(spark, sf, "events")
    early, late = _event_drops(events)
    held, rest = _split(early, F.col("event_id") % 3 == 0)
    for i, drop in enumerate((late.unionByName(rest), late.unionByName(held).unionByName(held))):
        stream = _stage_events(spark, events, landing, drop, i == 0)
        late_dedup.run_dedup_append(stream, ["event_id"], "ts", sink, ckpt, buckets=4)
    return norm(late_dedup.read_deduplicated(spark, sink))


def q_stream_expect_listener(spark, sf):
    """X5 on a plain append stream: counters stored by a query listener, over two runs of several batches."""
    landing, sink, ckpt = (scratch_dir(spark, n) for n in ("li-land", "li-sink", "li-ckpt"))
    events = broken_events(read_table(spark, sf, "events"))
    for i, drop in enumerate(_event_drops(events)):
        _stage_events(spark, events, landing, drop.repartition(3, "event_id"), i == 0)
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(landing)
        totals = counters.run_append_counted(stream, EVENT_RULES, sink, ckpt)
    rows = [(n, e, totals.get(n, 0), totals["total"]) for n, e in EVENT_RULES]
    return spark.createDataFrame(rows, "rule STRING, expectation STRING, failed_records BIGINT, total_records BIGINT")


def q_stream_scd1_restart(spark, sf):
    """X6 over a restart: newer changes first, then older ones with a fresh checkpoint and another bucket
    count; some users are NULL (one key)."""
    landing, other, target = (scratch_dir(spark, n) for n in ("scr-land", "scr-other", "scr-target"))
    events = null_users(read_table(spark, sf, "events"))
    for folder, drop, buckets in zip((landing, other), _event_drops(events, newer_first=True), (8, 16), strict=True):
        stream = _stage_events(spark, events, folder, drop, True)
        jobs.run_scd1(stream, ["user_id"], ["ts", "event_id"], target, scratch_dir(spark, "scr-ckpt"), buckets=buckets)
    return norm(jobs.read_scd1(spark, target))


def q_stream_scd1(spark, sf):
    """Latest event per user from a change stream; the older drop arrives last."""
    landing, target, ckpt = (scratch_dir(spark, n) for n in ("scd-land", "scd-target", "scd-ckpt"))
    events = read_table(spark, sf, "events")
    for i, drop in enumerate(_event_drops(events, newer_first=True)):
        stream = _stage_events(spark, events, landing, drop, i == 0)
        jobs.run_scd1(stream, ["user_id"], ["ts", "event_id"], target, ckpt, buckets=8)
    return norm(jobs.read_scd1(spark, target))


def q_scd1_latest(spark, sf):
    """D2 (batch): dimension state from the older half, then the newer half merged in."""
    events = read_table(spark, sf, "events")
    early, late = _event_drops(events)
    state = dims.scd1_latest(early, ["user_id"], ["ts", "event_id"])
    return norm(dims.scd1_latest(late, ["user_id"], ["ts", "event_id"], target=state))


def q_dim_tickers_scd1(spark, sf):
    """D1+D2: ticker change feed; a late, older version with other attributes is ignored."""
    bars, meta = load_bars(spark, sf), load_ticker_metadata(spark, sf)
    current = dims.dim_tickers_source(bars, meta, modified=check_stamp())
    older = dims.dim_tickers_source(bars, meta.withColumn("sector", F.lit("STALE")),
                                    modified=check_stamp() - F.expr("INTERVAL 1 DAY"))
    return norm(dims.scd1_latest(older, ["ticker_key"], ["modified_date"], target=current))


STREAM_QUERIES = {
    "ingest_bars": q_ingest_bars,
    "union_bars": q_union_bars,
    "export_roundtrip": q_export_roundtrip,
    "ingest_symbols": q_ingest_symbols,
    "ingest_listed": q_ingest_listed,
    "ingest_quarantine": q_ingest_quarantine,
    "metadata_records": q_metadata_records,
    "metadata_empty": q_metadata_empty,
    "view_of_table": q_view_of_table,
    "keys_and_stamps": q_keys_and_stamps,
    "upsert_bars": q_upsert_bars,
    "upsert_null_keys": q_upsert_null_keys,
    "refresh_indicators": q_refresh_indicators,
    "refresh_fact": q_refresh_fact,
    "incremental_monthly": q_incremental_monthly,
    "fact_weekly_merged": q_fact_weekly_merged,
    "fact_monthly_merged": q_fact_monthly_merged,
    "kpi_merged": q_kpi_merged,
    "distinct_tickers_monthly": q_distinct_tickers_monthly,
    "stream_scd1_restart": q_stream_scd1_restart,
    "stream_incremental_append": q_stream_incremental_append,
    "stream_union": q_stream_union,
    "stream_expect": q_stream_expect,
    "stream_dedup": q_stream_dedup,
    "stream_dedup_late": q_stream_dedup_late,
    "stream_expect_listener": q_stream_expect_listener,
    "stream_scd1": q_stream_scd1,
    "scd1_latest": q_scd1_latest,
    "dim_tickers_scd1": q_dim_tickers_scd1,
}

EVENTS_OUT = f"SELECT event_id, ts, user_id, event_type, {r4('value', 'value')}, props FROM events"
NULL_USERS = "(SELECT * REPLACE (CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_id END AS user_id) FROM events)"
BROKEN_EVENTS = (
    "(SELECT * REPLACE (CASE WHEN event_id % 11 = 0 THEN NULL ELSE user_id END AS user_id, "
    "CASE WHEN event_id % 13 = 0 THEN -1 WHEN event_id % 13 = 1 THEN 1000 ELSE value END AS value) FROM events)"
)


def latest_event_sql(src: str = "events") -> str:
    return (
        f"SELECT event_id, ts, user_id, event_type, {r4('value', 'value')}, props FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM {src}"
        ") WHERE rn = 1"
    )


def stream_oracle_sql() -> dict[str, str]:
    from candela.checks import oracle as O

    bars = f"{with_(BARS)} {bars_select()}"
    rules = " UNION ALL ".join(
        f"SELECT '{n}' AS rule, '{e.replace(chr(39), chr(39) * 2)}' AS expectation, "
        f"count(*) FILTER (WHERE NOT coalesce({e}, false)) AS failed_records, count(*) AS total_records FROM {BROKEN_EVENTS}"
        for n, e in EVENT_RULES
    )
    symbol = (
        "CASE ascii(right(ticker, 1)) % 4 WHEN 0 THEN ticker || '=F' WHEN 1 THEN 'A+' || ticker "
        "WHEN 2 THEN lpad(regexp_extract(ticker, '[0-9]*$'), 4, '0') ELSE '^' || ticker || '%x' END"
    )
    symbols = f"{with_(BARS)} {bars_select(f'(SELECT * REPLACE ({symbol} AS ticker) FROM bars)')}"
    broken = O._broken("(SELECT *, close AS adj FROM bars)", "close")
    columns = ", ".join(c if "adj_close" not in c else r4("adj", "adj_close") for c in O.BAR_OUT)
    stale = f"SELECT {columns.replace('(close)', '(close + 1.0)').replace('(adj)', '(adj + 1.0)')} FROM broken WHERE ticker IS NULL OR date IS NULL"
    reason = (
        "CASE day(date) WHEN 4 THEN 'short row: 4 fields' WHEN 6 THEN 'long row: 8 fields' WHEN 8 THEN 'not parsed: close' "
        "WHEN 9 THEN 'not parsed: date' WHEN 10 THEN 'not parsed: close, volume' END"
    )
    empty = ", ".join("NULL" for _ in BAR_COLUMNS[1:])
    quarantine = (
        f"{with_(BARS)} SELECT *, NULL AS reason, 1 AS n_rows FROM ({bars_select(f'(SELECT * FROM bars WHERE {reason} IS NULL)')}) "
        f"UNION ALL SELECT ticker, {empty}, {reason}, count(*) FROM bars WHERE {reason} IS NOT NULL GROUP BY ticker, {reason}"
    )
    return {
        "ingest_bars": bars,
        "ingest_quarantine": quarantine,
        "ingest_symbols": symbols,
        "union_bars": bars,
        "export_roundtrip": bars,
        "ingest_listed": f"{bars} WHERE ticker IN ({', '.join(repr(t) for t in LISTED)})",
        "metadata_records": O.dim_tickers_sql(),
        "metadata_empty": f"{with_(BARS, O.META.replace('FROM nation n', 'FROM (SELECT * FROM nation WHERE false) n'), O.DIM_TICKERS)} SELECT * FROM dim_tickers",
        "view_of_table": f"{with_(BARS)} SELECT ticker, count(*) AS bars, min(date) AS first_date, "
        "CAST(sum(volume) AS BIGINT) AS volume FROM bars GROUP BY ticker",
        "keys_and_stamps": f"{with_(BARS)} SELECT year(date) AS year, count(DISTINCT ticker) AS keys, "
        "count(DISTINCT ticker) AS tickers, true AS stamped FROM bars GROUP BY 1",
        "upsert_bars": bars,
        "upsert_null_keys": f"{with_(BARS, broken)} SELECT {columns} FROM broken UNION ALL {stale}",
        "refresh_indicators": O.silver_sql(),
        "refresh_fact": O.fact_sql(),
        "incremental_monthly": O.monthly_sql(),
        "fact_weekly_merged": O.weekly_sql(),
        "fact_monthly_merged": O.monthly_sql(),
        "kpi_merged": O.v_kpi_sql(),
        "distinct_tickers_monthly": f"{with_(BARS)} SELECT year(date) AS year, month(date) AS month, "
        f"count(DISTINCT {symbol}) AS unique_tickers FROM bars GROUP BY 1, 2",
        "stream_incremental_append": EVENTS_OUT,
        "stream_union": EVENTS_OUT,
        "stream_expect": rules,
        "stream_dedup": EVENTS_OUT,
        "stream_dedup_late": EVENTS_OUT,
        "stream_expect_listener": rules,
        "stream_scd1": latest_event_sql(),
        "stream_scd1_restart": latest_event_sql(NULL_USERS),
        "scd1_latest": latest_event_sql(),
        "dim_tickers_scd1": O.dim_tickers_sql(),
    }
