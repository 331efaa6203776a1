"""Incremental refresh: equal to a rebuild, whatever changed, and other files stay untouched."""

import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from candela.checks import streams
from candela.schema import BAR_COLUMNS
from candela.sinks import parts
from candela.sources.metadata import empty_ticker_metadata
from candela.streaming import jobs, refresh

SCHEMA = "ticker string, date date, open double, high double, low double, close double, adj_close double, volume bigint, processed_timestamp timestamp"
START = dt.date(2015, 1, 1)


def bars_of(rows, stamp):
    """Rows (ticker, day, seed) as bars."""
    out = []
    for ticker, day, seed in rows:
        rng = random.Random(f"{ticker}{day}{seed}")
        low, high = sorted((rng.uniform(5, 9), rng.uniform(9, 14)))
        o, c = rng.uniform(low, high), rng.uniform(low, high)
        out.append((ticker, START + dt.timedelta(day), o, high, low, c, c, rng.randrange(1, 1000), dt.datetime(2024, 1, stamp)))
    return out


@pytest.fixture
def case(spark, tmp_root):
    """Daily A and B, a sparse C (a row every 40 days), a short D; tables built from them."""
    days = {"A": range(0, 1400), "B": range(0, 1400), "C": range(0, 6000, 40), "D": range(600, 605)}
    rows = {(t, d): 0 for t, ds in days.items() for d in ds}
    base, target = f"{tmp_root}/bars", f"{tmp_root}/silver"
    jobs.create_bars_table(spark.createDataFrame(bars_of([(*k, v) for k, v in rows.items()], 1), SCHEMA), base, buckets=4)
    refresh.build_derived(spark, base, target, refresh.silver_table(), block_rows=200)
    return rows, base, target


def change(spark, tmp_root, case, updates, name="in", on_merged=True):
    rows, base, target = case
    rows.update(updates)
    spark.createDataFrame(bars_of([(*k, v) for k, v in updates.items()], 2), SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_root}/{name}")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_root}/{name}")
    run = lambda batch, k: refresh.refresh_indicators(spark, base, target, batch, f"{name}#{k}", block_rows=100)
    jobs.run_upsert_bars(spark, stream, base, f"{tmp_root}/ck-{name}", on_merged=run if on_merged else None)


def same_as_rebuilt(spark, case, tmp_root):
    _, base, target = case
    again = f"{tmp_root}/again-{random.random()}"
    refresh.build_derived(spark, base, again, refresh.silver_table(), block_rows=200)
    columns = ["ticker", "date", *[F.round(c, 6).alias(c) for c, t in refresh.read_derived(spark, target).dtypes if t in ("double", "bigint")]]
    a, b = (refresh.read_derived(spark, p).select(columns) for p in (target, again))
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
    return True


def files(path):
    out = {}
    for folder, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                out[f"{folder}/{n}"] = os.stat(f"{folder}/{n}").st_mtime_ns
    return out


def test_changes_in_the_middle_at_both_ends_and_new_rows(spark, tmp_root, case):
    updates = {("A", 700): 1, ("A", 0): 1, ("B", 1399): 1, ("B", 1400): 0, ("C", 3000): 1, ("C", 2990): 0, ("E", 50): 0, ("D", 602): 1}
    change(spark, tmp_root, case, updates)
    assert same_as_rebuilt(spark, case, tmp_root)
    assert refresh.read_derived(spark, case[2]).count() == len(case[0])


def test_other_parts_keep_their_files(spark, tmp_root, case):
    _, base, target = case
    before, bars_before = files(target), files(base)
    change(spark, tmp_root, case, {("A", 700): 1})
    after = files(target)
    gone = {f for f in before if f not in after}
    changed = {f.split("/_period=")[1].split("/")[0] for f in gone}
    months = sorted({(START + dt.timedelta(d)).strftime("%Y-%m") for d in range(700, 765)})
    assert changed == set(months)  # the changed row's month and those of the 64 rows behind it
    assert len(gone) <= 3 and all(after[f] == t for f, t in before.items() if f not in gone)
    assert len([f for f in bars_before if f not in files(base)]) == 1
    assert same_as_rebuilt(spark, case, tmp_root)


def test_only_the_look_back_is_read(spark, tmp_root, case):
    _, base, _ = case
    keys = spark.createDataFrame([("A", START + dt.timedelta(700)), ("A", START + dt.timedelta(20))], "ticker string, date date")
    bars = refresh._bars(spark, base)
    runs = refresh.affected_runs(bars, keys, 64, 4)
    assert runs.count() == 2
    read = refresh._in_runs(bars, runs)
    assert read.count() < 450 and read.select("ticker").distinct().count() == 1  # of 1,400 rows
    opened = read._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*_period#\d+ IN", opened) and read.select("_period").distinct().count() <= 15  # of 46 months
    sparse = refresh.affected_runs(bars, spark.createDataFrame([("C", START + dt.timedelta(3000))], "ticker string, date date"), 64, 4)
    assert refresh._in_runs(bars, sparse).where("ticker = 'C' and date < first").count() >= 64


def test_random_changes(spark, tmp_root, case):
    rng = random.Random(2)
    for k in range(3):
        updates = {(rng.choice("ABCD"), rng.randrange(0, 1500)): rng.randrange(9) for _ in range(rng.choice([1, 5, 60]))}
        change(spark, tmp_root, case, updates, name=f"in{k}")
    assert same_as_rebuilt(spark, case, tmp_root)


def test_a_refresh_that_crashed_is_completed(spark, tmp_root, case, monkeypatch):
    _, base, target = case
    plain = parts.replace_parts

    def die(df, path, names):
        if path == target:
            raise RuntimeError("Crash")
        plain(df, path, names)

    with monkeypatch.context() as m:
        m.setattr(parts, "replace_parts", die)
        with pytest.raises(Exception, match="Crash"):
            change(spark, tmp_root, case, {("B", 900): 3})
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_root}/in")
    jobs.run_upsert_bars(
        spark, stream, base, f"{tmp_root}/ck-in",
        on_merged=lambda batch, k: refresh.refresh_indicators(spark, base, target, batch, f"in#{k}", block_rows=100),
    )
    assert same_as_rebuilt(spark, case, tmp_root)


def test_rows_without_a_key_and_no_changes(spark, tmp_root, case):
    _, base, target = case
    before = files(target)
    none = spark.createDataFrame([(None, START), ("A", None)], "ticker string, date date")
    refresh.refresh_indicators(spark, base, target, none, "x")
    refresh.refresh_indicators(spark, base, target, none.limit(0), "y")
    assert files(target) == before and set(BAR_COLUMNS) <= set(refresh.read_derived(spark, target).columns)


@pytest.mark.parametrize("name", ["refresh_fact", "incremental_monthly"])
def test_bars_are_formed_once(spark, monkeypatch, name):
    days = [(t, d) for t in "AB" for d in (*range(50, 100, 3), *range(1020, 1070, 3))]  # about the corrected months
    rows = [(t, d + dt.timedelta(-19 * 365), *r) for t, d, *r, _ in bars_of([(*k, 0) for k in days], 1)]
    formed, schema = spark.sparkContext.accumulator(0), SCHEMA.rsplit(",", 1)[0]

    def counted(batches):
        for b in batches:
            formed.add(b.num_rows)
            yield b

    bars = spark.createDataFrame(rows, schema).mapInArrow(counted, schema)
    monkeypatch.setattr(streams, "load_bars", lambda spark, sf: bars)
    monkeypatch.setattr(streams, "load_ticker_metadata", lambda spark, sf: empty_ticker_metadata(spark))
    out = streams.STREAM_QUERIES[name](spark, "none")
    assert out.count() == (len(days) if name == "refresh_fact" else len({(t, d.year, d.month) for t, d, *_ in rows}))
    assert formed.value == len(days)
