"""Numbering in any order: plain row numbers, spread of a hot key, one exchange."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from candela.operators import frames, indicators
from candela.operators.frames import BLK, RN, number_rows
from candela.sources.tpch_bars import load_bars
from tests.conftest import SF_SMALL


def series(spark):
    """A hot key with most of the rows, small ones, a NULL key and a NULL order value."""
    rng = random.Random(1)
    rows = [("HOT", n) for n in rng.sample(range(100_000), 3000)] + [(f"t{k}", n) for k in range(300) for n in rng.sample(range(99), 3)]
    rows += [(None, n) for n in range(40)] + [("HOT", None), (None, None), ("", 5)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "ticker string, n long").repartition(7)


ORDERS = {
    "text": "format_string('%06d', n)", "time": "timestamp_seconds(n)", "number": "n", "fraction": "n / 7",
    "decimal": "cast(n / 8 as decimal(20,4))", "pair": "struct(n, 1 as m)",
}


@pytest.mark.parametrize("kind", ORDERS)
def test_equals_row_number(spark, kind):
    df = series(spark).withColumn("o", F.expr(f"case when n is not null then {ORDERS[kind]} end"))
    plain = df.withColumn("want", F.row_number().over(Window.partitionBy("ticker").orderBy("o"))).select("ticker", "n", "want")
    got = number_rows(df, order="o").select("ticker", "n", F.col(RN).cast("int").alias("want"))
    assert got.count() == plain.count() and got.exceptAll(plain).count() == 0


def test_hot_key_spreads_and_rows_move_once(spark):
    df = series(spark).withColumn("o", F.format_string("%06d", "n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the test's few rows would fit in one task
    try:
        numbered = number_rows(df, order="o")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Repartition") == 0 and "numbered" in numbered.inputFiles()[0]  # ranges were dealt once, when the rows were stored
    physical = numbered._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in physical and physical.count("Exchange hashpartitioning") == 2  # both over (key, partition) counts
    tasks = spark.read.parquet(numbered.inputFiles()[0].rsplit("/", 1)[0]).where("ticker = 'HOT'").select("_pid").distinct().count()
    assert tasks >= 4
    blocked = frames.with_blocks(numbered, 10, 64)
    assert blocked.where("ticker = 'HOT' and not _ghost").select(BLK).distinct().count() == 47


def test_windows_over_a_text_order_have_one_exchange(spark, tmp_root):
    load_bars(spark, SF_SMALL).withColumn("day", F.col("date").cast("string")).write.parquet(f"{tmp_root}/bars")
    bars = spark.read.parquet(f"{tmp_root}/bars")
    out = indicators.run_indicators(bars, ["sma", "rsi"], order="day", block_rows=100)
    physical = out._jdf.queryExecution().executedPlan().toString()
    rows = [line for line in physical.splitlines() if "Exchange hashpartitioning" in line and BLK in line]
    assert len(rows) == 1 and physical.count("Exchange hashpartitioning") == 3
    want = indicators.run_indicators(bars, ["sma", "rsi"], strategy="plain")
    columns = ["ticker", "date", *[F.round(c, 8).alias(c) for c in ("sma_5", "sma_50", "rsi")]]
    assert out.select(*columns).exceptAll(want.select(*columns)).count() == 0 and out.count() == want.count()


def test_empty_input(spark):
    assert number_rows(spark.createDataFrame([], "ticker string, n long"), order="n").count() == 0


def test_too_small_blocks_are_refused(spark):
    bars = spark.createDataFrame([("A", dt.date(2024, 1, 1), 1.0)], "ticker string, date date, close double")
    with pytest.raises(ValueError, match="look-back"):
        indicators.run_indicators(bars, ["sma"], block_rows=20)
    with pytest.raises(ValueError, match="look-back"):
        indicators.IndicatorChain(bars, "ticker", "date", block_rows=20).sma().get_df()
    assert frames.fitting_block_rows(5000) == 20_000
