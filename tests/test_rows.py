"""Rows that ingest, merges and streams must not lose or change, on hand-made inputs."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from candela.operators.dedup import dedup_bars
from candela.operators.ema import ema
from candela.session import ensure_checkpoint_dir, scratch_dir
from candela.sources.csv_bars import read_bars_csv, read_bars_stream, write_bars_csv
from candela.streaming import jobs

CSV = "Date,Open,High,Low,Close,Adj Close,Volume\n2024-01-0{d},1,2,0.5,1.5,1.5,{d}\n"
BAR = "ticker string, date date, open double, high double, low double, close double, adj_close double, volume bigint"
SYMBOLS = ["CL=F", "EURUSD=X", "A+B", "0005", "0700", "^GSPC", "50%OFF", "BRK.B", "A B", "é", "x{y}[z]", "a,b", "#h", "q?"]


@pytest.fixture()
def root():
    return tempfile.mkdtemp(prefix="candela-rows-")


def _bars(spark, rows):
    return spark.createDataFrame([(t, d, 1.0, 2.0, 0.5, c, c, v) for t, d, c, v in rows], BAR)


def test_tickers_as_the_source_writes_them(spark, root):
    for k, s in enumerate(SYMBOLS):
        os.makedirs(f"{root}/{s}")
        with open(f"{root}/{s}/bars.csv", "w") as f:
            f.write(CSV.format(d=k % 9 + 1))
    got = read_bars_csv(spark, root)
    assert sorted(r["ticker"] for r in got.collect()) == sorted(SYMBOLS)
    assert dict(got.dtypes)["ticker"] == "string"
    some = read_bars_csv(spark, root, tickers=["CL=F", "0005", "x{y}[z]", "a,b", "missing"])
    assert sorted(r["ticker"] for r in some.collect()) == ["0005", "CL=F", "a,b", "x{y}[z]"]
    assert read_bars_csv(spark, root, tickers=[]).count() == 0


def test_tickers_from_partitioned_drops(spark, root):
    rows = [(s, dt.date(2024, 1, 2), 1.5, k) for k, s in enumerate(SYMBOLS)] + [(None, dt.date(2024, 1, 2), 1.5, 99)]
    write_bars_csv(_bars(spark, rows), f"{root}/raw")
    got = {r["volume"]: r["ticker"] for r in read_bars_csv(spark, f"{root}/raw").collect()}
    assert got == {v: t for t, _, _, v in rows}
    listed = read_bars_csv(spark, f"{root}/raw", tickers=["A+B", "50%OFF", "CL=F"])
    assert sorted(r["ticker"] for r in listed.collect()) == ["50%OFF", "A+B", "CL=F"]
    jobs.run_append(read_bars_stream(spark, f"{root}/raw", tickers=[]), f"{root}/none", f"{root}/ck-none")
    jobs.run_append(read_bars_stream(spark, f"{root}/raw"), f"{root}/all", f"{root}/ck-all", partition_by=["ticker"])
    stored = spark.read.schema(BAR).parquet(f"{root}/all")
    assert {r["volume"]: r["ticker"] for r in stored.collect()} == got


def test_dedup_keeps_rows_without_a_key(spark):
    stamp = dt.datetime(2024, 1, 1)
    rows = [("A", dt.date(2024, 1, 2), 1.0, stamp), ("A", dt.date(2024, 1, 2), 2.0, stamp + dt.timedelta(1)),
            ("A", None, 3.0, stamp), ("A", None, 4.0, stamp), (None, dt.date(2024, 1, 2), 5.0, stamp), (None, None, 6.0, stamp)]
    df = spark.createDataFrame(rows, "ticker string, date date, close double, processed_timestamp timestamp")
    assert sorted(r["close"] for r in dedup_bars(df).collect()) == [2.0, 3.0, 4.0, 5.0, 6.0]


def test_upsert_keeps_null_keys_and_other_periods(spark, root):
    day = dt.date(2024, 1, 2)
    stored = _bars(spark, [("A", day, 1.0, 1), (None, day, 2.0, 2), (None, day, 3.0, 3), ("B", dt.date(2024, 3, 1), 4.0, 4), ("0005", day, 5.0, 5)])
    jobs.create_bars_table(jobs.with_load_stamp(stored), f"{root}/t", buckets=2)
    files = lambda month: sorted(
        os.path.join(d, f) for d, _, fs in os.walk(f"{root}/t/_period={month}") for f in fs if f.endswith(".parquet"))
    untouched, touched = files("2024-03"), files("2024-01")
    assert untouched and touched
    write_bars_csv(_bars(spark, [("A", day, 9.0, 1), (None, day, 8.0, 8), ("C", None, 7.0, 7)]), f"{root}/raw")
    stream = jobs.with_load_stamp(read_bars_stream(spark, f"{root}/raw"))
    jobs.run_upsert_bars(spark, stream, f"{root}/t", f"{root}/ck", buckets=99)
    got = jobs.read_bars_table(spark, f"{root}/t")
    assert dict(got.dtypes)["ticker"] == "string"
    rows = sorted((r["volume"], r["ticker"], r["close"]) for r in got.collect())
    assert rows == [(1, "A", 9.0), (2, None, 2.0), (3, None, 3.0), (4, "B", 4.0), (5, "0005", 5.0), (7, "C", 7.0), (8, None, 8.0)]
    assert files("2024-03") == untouched and files("2024-01") != touched
    # a batch that is run again with the same id replaces its own rows
    jobs.run_upsert_bars(spark, stream, f"{root}/t", f"{root}/ck")
    assert jobs.read_bars_table(spark, f"{root}/t").count() == 7


CHANGE = "k string, seq int, v string"


def _changes(spark, root, name, rows):
    spark.createDataFrame(rows, CHANGE).coalesce(1).write.parquet(f"{root}/{name}")
    return spark.readStream.schema(CHANGE).parquet(f"{root}/{name}")


def test_scd1_over_restarts_null_keys_and_bucket_counts(spark, root):
    target = f"{root}/dim"
    jobs.run_scd1(_changes(spark, root, "a", [("x", 5, "new"), (None, 1, "n1"), ("y", 1, "y1")]), ["k"], ["seq"], target, f"{root}/c1", buckets=8)
    jobs.run_scd1(_changes(spark, root, "b", [("x", 1, "OLD"), (None, 2, "n2"), ("y", 2, "y2")]), ["k"], ["seq"], target, f"{root}/c2", buckets=16)
    got = {r["k"]: (r["seq"], r["v"]) for r in jobs.read_scd1(spark, target).collect()}
    assert got == {"x": (5, "new"), None: (2, "n2"), "y": (2, "y2")}
    assert jobs.read_scd1(spark, target).count() == 3


def test_expectations_count_every_batch_once(spark, root):
    schema = "k string, n int"
    for part in range(4):
        spark.createDataFrame([(None if i == 0 else "a", i) for i in range(5)], schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
    read = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    rules = [("known", "k IS NOT NULL"), ("small", "n < 3")]
    first = jobs.run_append_with_expectations(read(), rules, f"{root}/out", f"{root}/ck", partition_by=["k"])
    assert first == {"total": 20, "known": 4, "small": 8}
    assert jobs.run_append_with_expectations(read(), rules, f"{root}/out", f"{root}/ck", partition_by=["k"]) == {}
    # the same batches once more, as after a crash before the checkpoint's commit
    jobs.run_append_with_expectations(read(), rules, f"{root}/out", f"{root}/ck-new", partition_by=["k"])
    assert jobs.expectation_counts(spark, f"{root}/out") == first
    assert jobs.read_appended(spark, f"{root}/out").count() == 20


def test_appends_write_few_files_per_folder(spark, root):
    spark.range(20_000).selectExpr("cast(id % 3 as string) t", "id").repartition(40).write.parquet(f"{root}/in")
    stream = spark.readStream.schema("t string, id long").parquet(f"{root}/in")
    jobs.run_append(stream, f"{root}/out", f"{root}/ck", partition_by=["t"], files_per_partition=2)
    for t in "012":
        assert len([f for f in os.listdir(f"{root}/out/t={t}") if f.endswith(".parquet")]) <= 2


def test_ema_keeps_nan_apart_from_null(spark):
    rows = [(t, k, c) for t, values in {"nan": [1.0, float("nan"), 2.0], "null": [1.0, None, 2.0], None: [1.0, 2.0, 3.0]}.items()
            for k, c in enumerate(values)]
    df = spark.createDataFrame(rows, "ticker string, n int, close double")
    for block in (2, 4096):
        got = {(r["ticker"], r["n"]): r["ema_12"] for r in ema(df, order="n", block_rows=block).collect()}
        assert got["nan", 0] == 1.0 and all(got["nan", k] != got["nan", k] for k in (1, 2))
        assert got["null", 0] == 1.0 and got["null", 1] is None and got["null", 2] is None
        assert got[None, 2] == pytest.approx(2 / 13 * 3 + 11 / 13 * (2 / 13 * 2 + 11 / 13 * 1))


def test_scratch_folders_keep_the_scheme(spark):
    root = ensure_checkpoint_dir(spark)
    assert scratch_dir(spark, "x").startswith(root)


def test_late_first_copies_stay_within_the_delay(spark, root):
    schema = "id long, ts timestamp"
    rows = lambda days: [(d, dt.datetime(2024, 1, 1) + dt.timedelta(d)) for d in days]
    stream = lambda: jobs.dedup_stream(spark.readStream.schema(schema).parquet(f"{root}/in"), ["id"], "ts", "30 days")
    for days in ((1, 2, 20), (20, 3, 2)):
        spark.createDataFrame(rows(days), schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        jobs.run_append(stream(), f"{root}/out", f"{root}/ck")
    assert sorted(r["id"] for r in spark.read.parquet(f"{root}/out").collect()) == [1, 2, 3, 20]


def test_blocks_refuse_a_look_back_that_does_not_fit(spark):
    from candela.operators.frames import rolling

    df = spark.range(5).select(F.lit("a").alias("ticker"), F.col("id").cast("int").alias("date"))
    with pytest.raises(ValueError):
        rolling(df, lambda d, w: d, lookback=64, block_rows=10)


def test_scratch_folders_go_at_the_end_of_a_scope(spark):
    from candela import session

    before = scratch_dir(spark, "before")
    spark.range(1).write.parquet(before)
    with session.scratch_scope(spark):
        inside = scratch_dir(spark, "inside")
        spark.range(1).write.parquet(inside)
        with session.scratch_scope(spark):
            scratch_dir(spark, "never-written")
        assert os.path.exists(inside)
    assert os.path.exists(before) and not os.path.exists(inside)
    kept = session._MADE.index(before)
    assert session.clear_scratch(spark, kept) >= 1 and not os.path.exists(before)
