"""Stream dedup by stored Bloom filters, and counters by a query listener."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from candela.streaming import counters, jobs, late_dedup
from candela.streaming.late_dedup import read_deduplicated, run_dedup_append

SCHEMA = "id long, sub string, ts timestamp, v string"


@pytest.fixture
def root(tmp_root):
    return tmp_root


def drop(spark, root, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")


def event(key, day, v="x", sub="s"):
    return key, sub, dt.datetime(2024, 1, 1) + dt.timedelta(days=day), v


def test_first_copies_stay_however_late(spark, root):
    rng, want, order = random.Random(1), {}, []
    for k in range(5):
        rows = [event(rng.choice([None, *range(400)]), rng.randrange(300), f"{k}-{i}", rng.choice(["a", None])) for i in range(250)]
        order.append(rows)
        firsts = {}
        for r in rows:
            key = r[:2]
            if key not in want and (key not in firsts or (r[2], r[0] or 0, r[3]) < (firsts[key][2], firsts[key][0] or 0, firsts[key][3])):
                firsts[key] = r
        want.update(firsts)
        stream = drop(spark, root, rows)
        run_dedup_append(stream, ["id", "sub"], "ts", f"{root}/out", f"{root}/ck", buckets=3)
        got = {tuple(r)[:2]: tuple(r) for r in read_deduplicated(spark, f"{root}/out").collect()}
        assert got == want and read_deduplicated(spark, f"{root}/out").count() == len(want)


def test_a_batch_that_runs_again_replaces_itself(spark, root, monkeypatch):
    stream = drop(spark, root, [event(k, k) for k in range(50)])
    run = lambda: run_dedup_append(stream, ["id"], "ts", f"{root}/out", f"{root}/ck", buckets=2)
    run()
    drop(spark, root, [event(k, k, "late") for k in range(30, 80)])
    plain = jobs.BatchSink.append
    for when in ("before", "behind"):  # filters without rows; rows and counters without the stream's commit

        def die(self, rows, batch_id, rules=(), when=when):
            if when == "behind":
                plain(self, rows, batch_id, rules)
            raise RuntimeError("Crash")

        with monkeypatch.context() as m:
            m.setattr(jobs.BatchSink, "append", die)
            with pytest.raises(Exception, match="Crash"):
                run()
    run()
    got = read_deduplicated(spark, f"{root}/out").collect()
    assert sorted(r["id"] for r in got) == list(range(80)) and {r["v"] for r in got if r["id"] < 50} == {"x"}


def test_only_parts_that_may_hold_a_key_are_opened(spark, root):
    keys = spark.range(60_000).select("id", F.lit("s").alias("sub"), F.date_add(F.lit("2024-01-01"), (F.col("id") % 366).cast("int")).cast("timestamp").alias("ts"), F.lit("x").alias("v"))
    rows = keys.withColumns({jobs.BUCKET: F.pmod(F.xxhash64("id"), F.lit(4)), jobs.PERIOD: F.date_format("ts", "yyyy-MM")})
    filters = late_dedup.bloom_filters(rows, ["id"]).checkpoint()
    stored = filters.agg(F.sum(F.length(late_dedup.BITS))).first()[0]
    assert filters.select(jobs.PERIOD, jobs.BUCKET).distinct().count() == 48 and stored <= 48 * 4096
    one = rows.where("id = 777").select(jobs.BUCKET, "id")
    found = [tuple(r) for r in late_dedup.parts_that_may_hold(one, filters, ["id"]).collect()]
    assert tuple(rows.where("id = 777").select(jobs.PERIOD, jobs.BUCKET).first()) in found and len(found) <= 3
    # no key is missed, and few parts are opened in vain
    for key in (0, 5, 59_999):
        mine = rows.where(F.col("id") == key)
        assert late_dedup.parts_that_may_hold(mine.select(jobs.BUCKET, "id"), filters, ["id"]).join(mine, [jobs.PERIOD, jobs.BUCKET]).count() == 1
    new = spark.range(100_000, 100_200).withColumn(jobs.BUCKET, F.pmod(F.xxhash64("id"), F.lit(4)))
    probe = new.crossJoin(filters.select(late_dedup.BLOCKS).distinct().limit(1)).select("id", jobs.BUCKET)
    opened = [late_dedup.parts_that_may_hold(probe.where(F.col("id") == k), filters, ["id"]).count() for k in range(100_000, 100_010)]
    assert sum(opened) <= 10 * 12 * 0.1


def test_a_part_spreads_over_tasks_and_its_filter_is_that_of_all_hashes(spark):
    rows = spark.range(30_000).select("id", F.lit(1).cast("long").alias(jobs.BUCKET), F.lit("2024-01").alias(jobs.PERIOD)).checkpoint()
    names = [jobs.PERIOD, jobs.BUCKET, late_dedup.BLOCKS, late_dedup.BLOCK]
    threshold, adaptive = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"
    before = {k: spark.conf.get(k) for k in (threshold, adaptive)}
    try:
        spark.conf.set(threshold, "-1")
        spark.conf.set(adaptive, "false")
        got = late_dedup.bloom_filters(rows, ["id"]).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    blocks = got[0][late_dedup.BLOCKS]
    assert blocks == 16 and len(got) == 16 and len({r["task"] for r in got}) > 2
    bits = rows.withColumn(late_dedup.BLOCKS, F.lit(blocks).cast("long")).withColumn(late_dedup.BLOCK, late_dedup._block_of(["id"], F.col(late_dedup.BLOCKS)))
    plain = bits.select(*names, F.explode(late_dedup._places(["id"])).alias("bit")).groupBy(*names).agg(F.bitmap_construct_agg("bit").alias("bits"))
    assert {tuple(r) for r in plain.collect()} == {tuple(r[:5]) for r in got}


def test_a_large_part_has_several_writers_and_stored_keys_are_not_broadcast(spark, root, monkeypatch):
    monkeypatch.setattr(late_dedup, "TASK_ROWS", 20, raising=False)
    plans, plain = [], late_dedup._stored_keys

    def seen(spark, sink_path, places, keys, batch_id):
        stored = plain(spark, sink_path, places, keys, batch_id)
        if stored is not None:
            stored.count()
            one = spark.createDataFrame([(1,)], "id long")
            joined = late_dedup.without_stored(one, stored, keys)
            plans.append(joined._jdf.queryExecution().optimizedPlan().toString())
        return stored

    monkeypatch.setattr(late_dedup, "_stored_keys", seen)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"  # so few rows would be one task all the same
    spark.conf.set(coalesce, "false")
    try:
        for ids in (range(200), range(100, 300)):
            stream = drop(spark, root, [event(k, 1) for k in ids])
            run_dedup_append(stream, ["id"], "ts", f"{root}/out", f"{root}/ck", buckets=1)
    finally:
        spark.conf.unset(coalesce)
    assert sorted(r["id"] for r in read_deduplicated(spark, f"{root}/out").collect()) == list(range(300))
    folder = f"{root}/out/_period=2024-01/_bucket=0"
    assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) > 2  # one per batch before
    assert plans and all("strategy=merge" in p for p in plans)


RULES = [("known", "sub IS NOT NULL"), ("early", "id < 5")]


def counted(spark, root, stream):
    return counters.run_append_counted(stream, RULES, f"{root}/out", f"{root}/ck", partition_by=["sub"])


def test_counters_over_runs_restarts_and_lost_reports(spark, root):
    for k in range(3):
        stream = drop(spark, root, [event(i, k, sub=None if i == 0 else "s") for i in range(10)])
    assert counted(spark, root, stream) == {"total": 30, "known": 3, "early": 15}
    assert counted(spark, root, stream) == {"total": 30, "known": 3, "early": 15}  # nothing new
    drop(spark, root, [event(9, 9)])
    assert counted(spark, root, stream) == {"total": 31, "known": 3, "early": 16}
    folder = f"{root}/out_rule_counts"
    assert sorted(f for f in os.listdir(folder) if f.endswith(".json") and not f.startswith(".")) == [f"batch-{k}.json" for k in range(4)]
    os.remove(f"{folder}/batch-1.json")  # a report that a crash has lost
    drop(spark, root, [event(1, 9)])
    assert counted(spark, root, stream) == {"total": 32, "known": 3, "early": 16}
    assert json.load(open(f"{folder}/upto-3.json"))["counts"]["total"] == 31
    assert spark.read.schema(SCHEMA).parquet(f"{root}/out").count() == 32


def test_an_empty_run_has_no_counts(spark, root):
    os.makedirs(f"{root}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in")
    assert counted(spark, root, stream) == {}
