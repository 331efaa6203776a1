"""Part tables and batch sinks over crashes: no row is lost, none is doubled."""

import datetime as dt
import os
import shutil
import uuid

import pytest
from pyspark.sql import functions as F

from candela.files import folder_names
from candela.sinks import parts
from candela.streaming import jobs

CHANGE = "k string, seq int, v string"


class Crash(Exception):
    pass


@pytest.fixture
def root(tmp_root):
    return tmp_root


def crash_between_delete_and_rename(monkeypatch):
    """Publishing deletes the part folders that it has rows for and stops, as a driver that dies between both steps."""

    def die(df, path, names):
        for row in df.select(*names).distinct().collect():
            folder = "/".join(f"{n}={row[n]}" for n in names)
            if os.path.exists(f"{path}/{folder}"):
                shutil.move(f"{path}/{folder}", f"{path}/.gone-{uuid.uuid4().hex}")
        raise Crash

    monkeypatch.setattr(parts, "replace_parts", die)


def changes(spark, root, name, rows):
    spark.createDataFrame(rows, CHANGE).coalesce(1).write.mode("append").parquet(f"{root}/{name}")
    return spark.readStream.schema(CHANGE).parquet(f"{root}/{name}")


@pytest.mark.parametrize("fresh", [False, True])
@pytest.mark.parametrize("buckets", [1, 4])
def test_a_part_that_a_crash_left_missing_comes_back(spark, root, monkeypatch, buckets, fresh):
    target, keys = f"{root}/dim", [f"k{i}" for i in range(20)]
    run = lambda ckpt: jobs.run_scd1(stream, ["k"], ["seq"], target, f"{root}/{ckpt}", buckets=buckets)
    stream = changes(spark, root, "in", [(k, 1, "old") for k in keys])
    run("ck")
    stream = changes(spark, root, "in", [("k3", 2, "new"), ("k20", 1, "first")])
    with monkeypatch.context() as m:
        crash_between_delete_and_rename(m)
        with pytest.raises(Exception, match="Crash"):
            run("ck")
    assert jobs.read_scd1(spark, target) is None if buckets == 1 else jobs.read_scd1(spark, target).count() < 20
    run("ck-fresh" if fresh else "ck")  # the same checkpoint runs the batch again; a fresh one starts from the first file
    got = {r["k"]: r["v"] for r in jobs.read_scd1(spark, target).collect()}
    assert got == {**dict.fromkeys(keys, "old"), "k3": "new", "k20": "first"}
    assert jobs.read_scd1(spark, target).count() == 21 and folder_names(spark, f"{target}/_redo") == []


def test_a_complete_record_is_published_not_merged_again(spark, root, monkeypatch):
    target = f"{root}/dim"
    stream = changes(spark, root, "in", [("a", 1, "x")])
    with monkeypatch.context() as m:
        crash_between_delete_and_rename(m)
        with pytest.raises(Exception, match="Crash"):
            jobs.run_scd1(stream, ["k"], ["seq"], target, f"{root}/ck", buckets=2)
    merged = []
    plain = jobs.scd1_latest
    monkeypatch.setattr(jobs, "scd1_latest", lambda df, *a: (merged.append(len(a)), plain(df, *a))[1])
    parts.finish_pending(spark, target)
    assert merged == [] and [tuple(r) for r in jobs.read_scd1(spark, target).collect()] == [("a", 1, "x")]


def test_a_record_without_its_mark_is_dropped(spark, root):
    schema = spark.createDataFrame([], "k int, p int").schema
    parts.create(spark, f"{root}/t", schema)
    rows = lambda *ks: spark.createDataFrame([(k, 0) for k in ks], "k int, p int")
    parts.publish(spark, f"{root}/t", ["p"], "first", lambda: rows(1, 2))
    rows(7).write.parquet(f"{root}/t/_redo/half/rows")  # a crash while the record was written
    assert parts.finish_pending(spark, f"{root}/t") == []
    assert sorted(r["k"] for r in parts.read_parts(spark, f"{root}/t").collect()) == [1, 2]
    assert folder_names(spark, f"{root}/t/_redo") == []


def bars_of(spark, rows):
    return spark.createDataFrame(rows, "ticker string, date date, close double, processed_timestamp timestamp")


def bar(ticker, day, close, stamp):
    return ticker, dt.date(2024, 1 + day // 28, 1 + day % 28), close, dt.datetime(2024, 6, stamp)


def test_upsert_over_a_crash(spark, root, monkeypatch):
    target = f"{root}/bars"
    jobs.create_bars_table(bars_of(spark, [bar(t, d, 1.0, 1) for t in "ABC" for d in range(60)]), target, buckets=2)
    bars_of(spark, [bar("A", 3, 9.0, 2), bar("D", 40, 5.0, 2), (None, None, 7.0, dt.datetime(2024, 6, 2))]).write.parquet(f"{root}/in")
    run = lambda: jobs.run_upsert_bars(
        spark, spark.readStream.schema(bars_of(spark, []).schema).parquet(f"{root}/in"), target, f"{root}/ck"
    )
    with monkeypatch.context() as m:
        crash_between_delete_and_rename(m)
        with pytest.raises(Exception, match="Crash"):
            run()
    run()
    got = {(r["ticker"], r["date"]): r["close"] for r in jobs.read_bars_table(spark, target).collect()}
    assert len(got) == 182 and got["A", dt.date(2024, 1, 4)] == 9.0 and got["B", dt.date(2024, 1, 4)] == 1.0
    assert jobs.read_bars_table(spark, target).count() == 182


def test_a_replaced_table_survives_a_crash(spark, root, monkeypatch):
    path = f"{root}/dim"
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").write.parquet(path)
    both = spark.read.parquet(path).unionByName(spark.createDataFrame([(3, "c")], "k int, v string"))
    with monkeypatch.context() as m:
        m.setattr(parts, "finish_table", lambda spark, path: None)
        parts.replace_table(both, path, "x")  # stops when the record is complete
    shutil.rmtree(path)  # and the table is half replaced
    parts.finish_table(spark, path)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "b"), (3, "c")]
    assert folder_names(spark, root) == ["dim"]


def events(spark, root, n, at=0):
    spark.createDataFrame([(f"t{i % 7}", dt.date(2024, 1 + (at + i) % 3, 1), i) for i in range(n)], "ticker string, date date, n int").coalesce(
        1
    ).write.mode("append").parquet(f"{root}/in")
    return spark.readStream.schema("ticker string, date date, n int").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")


def test_fifty_batches_keep_the_number_of_folders(spark, root):
    for k in range(50):
        stream = events(spark, root, 6, k)
    found = jobs.run_append_with_expectations(stream, [("small", "n < 3")], f"{root}/out", f"{root}/ck", files_per_partition=1)
    assert found == {"total": 300, "small": 150}
    assert [f for f in folder_names(spark, f"{root}/out") if not f.startswith("_c") and f != "_layout"] == [f"_period=2024-0{m}" for m in (1, 2, 3)]
    assert folder_names(spark, f"{root}/out/_counts") == [] and jobs.read_appended(spark, f"{root}/out").count() == 300


@pytest.mark.parametrize("step", ["rows", "counts"])
def test_a_batch_that_stops_half_way_counts_once(spark, root, monkeypatch, step):
    stream = events(spark, root, 10)
    run = lambda: jobs.run_append_with_expectations(stream, [("small", "n < 3")], f"{root}/out", f"{root}/ck")
    plain = jobs.BatchSink.append

    def die(self, rows, batch_id, rules=()):
        if step == "rows":  # rows without counters
            monkeypatch.setattr(self.spark, "createDataFrame", lambda *a, **kw: (_ for _ in ()).throw(Crash()))
        plain(self, rows, batch_id, rules)
        raise Crash  # counters are written, the stream has not committed

    with monkeypatch.context() as m:
        m.setattr(jobs.BatchSink, "append", die)
        with pytest.raises(Exception, match="Crash"):
            run()
        monkeypatch.undo()
    assert run() == {"total": 10, "small": 7}
    assert jobs.read_appended(spark, f"{root}/out").count() == 10 and spark.read.parquet(f"{root}/out").count() == 20


# -- buckets that split -----------------------------------------------------------


def test_every_key_has_one_bucket_in_any_directory(spark):
    ids = [(1 << 1) | 0, (1 << 2) | 1, (1 << 3) | 3, (1 << 4) | 7, (1 << 4) | 15]  # 0, 01, 011, 0111 and 1111 from the last bit on
    df = spark.range(5000).withColumn("b", parts.bucket_in(["id"], ids)).withColumn("h", F.xxhash64("id"))
    got = {r["b"]: r["n"] for r in df.groupBy("b").agg(F.count("*").alias("n")).collect()}
    assert set(got) == set(ids) and abs(got[2] - 2500) < 200 and abs(got[31] - 312) < 90
    assert df.where("b = 2 and h % 2 <> 0").count() == 0
    assert spark.range(9).select(parts.bucket_in(["id"], [1]).alias("b")).distinct().collect()[0]["b"] == 1


def test_buckets_split_between_batches_and_the_result_stays(spark, root):
    target, want = f"{root}/dim", {}
    sizes = []
    for k in range(5):
        rows = [(f"key{i:05d}", k, f"v{k}" * 20) for i in range(k * 300, k * 300 + 900)]
        want.update((r[0], r) for r in rows)
        stream = changes(spark, root, "in", rows)
        jobs.run_scd1(stream, ["k"], ["seq"], target, f"{root}/ck", buckets=2, most_part_bytes=2_500)
        got = {r["k"]: tuple(r) for r in jobs.read_scd1(spark, target).collect()}
        assert got == want and jobs.read_scd1(spark, target).count() == len(want)
        sizes.append(len(parts.directory(spark, target)))
    folders = {int(f.split("=")[1]) for f in folder_names(spark, target) if f.startswith("_bucket=")}
    assert sizes[0] > 2 and sizes[-1] > sizes[0] and folders == set(parts.directory(spark, target))


@pytest.mark.parametrize("step", ["replace_parts", "_write_directory", "delete_path"])
def test_a_split_that_stops_loses_and_doubles_nothing(spark, root, monkeypatch, step):
    target = f"{root}/dim"
    stream = changes(spark, root, "in", [(f"k{i}", 1, "x" * 30) for i in range(800)])
    run = lambda most: jobs.run_scd1(stream, ["k"], ["seq"], target, f"{root}/ck", buckets=2, most_part_bytes=most)
    run(1 << 30)
    changes(spark, root, "in", [("k5", 2, "new")])
    plain, calls = getattr(parts, step), []

    def die(*a, **kw):
        inside = any(isinstance(x, str) and "_bucket=" in x for x in a) if step == "delete_path" else len(calls) == (1 if step == "replace_parts" else 0)
        calls.append(1)
        if inside:
            raise Crash
        return plain(*a, **kw)

    with monkeypatch.context() as m:
        m.setattr(parts, step, die)
        with pytest.raises(Exception, match="Crash"):
            run(1_000)
    for most in (1_000, 1 << 30):
        got = {r["k"]: r["v"] for r in jobs.read_scd1(spark, target).collect()}
        assert len(got) == 800 == jobs.read_scd1(spark, target).count() and got["k5"] == "new"
        run(most)


def test_bars_tables_split_in_every_month(spark, root):
    target = f"{root}/bars"
    rows = [bar(f"t{k}", d, float(k), 1) for k in range(60) for d in range(0, 56, 2)]
    jobs.create_bars_table(bars_of(spark, rows), target, buckets=1)
    bars_of(spark, [bar("t7", 4, 99.0, 2)]).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(bars_of(spark, []).schema).parquet(f"{root}/in")
    jobs.run_upsert_bars(spark, stream, target, f"{root}/ck", most_part_bytes=2_000)
    got = {(r["ticker"], r["date"]): r["close"] for r in jobs.read_bars_table(spark, target).collect()}
    assert len(got) == len(rows) == jobs.read_bars_table(spark, target).count() and got["t7", dt.date(2024, 1, 5)] == 99.0
    assert parts.directory(spark, target) == [2, 3] and folder_names(spark, f"{target}/_period=2024-01") == ["_bucket=2", "_bucket=3"]
