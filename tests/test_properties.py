"""Invariants over the derived bars and their indicators / facts."""

import pytest
from pyspark.sql import functions as F

from candela.operators import dims, facts, indicators
from candela.sources.tpch_bars import load_bars, load_ticker_metadata
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def chain(spark):
    bars = load_bars(spark, SF_SMALL).cache()
    silver = indicators.silver_indicators(bars, "plain").cache()
    fact = facts.fact_daily(
        silver, dims.dim_date(bars), dims.dim_tickers_source(bars, load_ticker_metadata(spark, SF_SMALL)), "plain"
    ).cache()
    return bars, silver, fact


def test_bar_ordering(chain):
    bars = chain[0]
    bad = bars.where(~((F.col("low") <= F.least("open", "close")) & (F.greatest("open", "close") <= F.col("high"))))
    assert bad.count() == 0


def test_oscillators_bounded(chain):
    s = chain[1]
    for c in ("rsi", "mfi", "stoch_oscillator", "stoch_signal"):
        assert s.where(F.col(c).isNotNull() & ((F.col(c) < -1e-9) | (F.col(c) > 100 + 1e-9))).count() == 0, c


def test_weekly_monthly_sum_to_daily(chain):
    fact = chain[2]
    daily = fact.agg(F.sum("volume")).first()[0]
    w = facts.fact_weekly(fact)
    m = facts.fact_monthly(fact)
    assert w.agg(F.sum("week_volume")).first()[0] == daily
    assert m.agg(F.sum("month_volume")).first()[0] == daily
    assert w.where(F.col("green_days") + F.col("red_days") > F.col("trading_day")).count() == 0
    assert m.agg(F.sum("trading_days")).first()[0] == fact.count()


@pytest.mark.parametrize("block_rows", [65, 100, 257])
def test_blocks_equal_plain(chain, block_rows):
    bars, silver = chain[0], chain[1]
    blk = indicators.silver_indicators(bars, "blocks", block_rows=block_rows)
    num = [c for c, t in silver.dtypes if t in ("double", "bigint")]
    a = silver.select("ticker", "date", *[F.round(c, 8).alias(c) for c in num])
    b = blk.select("ticker", "date", *[F.round(c, 8).alias(c) for c in num])
    assert blk.count() == silver.count()
    assert a.exceptAll(b).count() == 0


def test_same_results_with_ansi_on_and_off(spark, chain):
    bars = chain[0]
    num = lambda df: df.select("ticker", "date", *[F.round(c, 8).alias(c) for c, t in df.dtypes
                                                  if t in ("double", "bigint")])
    results = {}
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            s = indicators.silver_indicators(bars, "blocks")
            results[ansi] = num(s).collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")
    assert sorted(results["true"]) == sorted(results["false"])


def test_hot_ticker_is_split_into_blocks(spark):
    """One ticker with most of the rows spreads over many (ticker, block) groups; results stay exact."""
    from candela.operators.frames import BLK, number_rows, with_blocks

    hot = spark.range(0, 3000).select(
        F.lit("HOT").alias("ticker"), F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
        (F.lit(100.0) + F.sin(F.col("id") / 7.0) * 5).alias("close"))
    cold = spark.range(0, 40).select(
        F.lit("COLD").alias("ticker"), F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
        (F.lit(50.0) + F.col("id") / 10.0).alias("close"))
    bars = hot.unionByName(cold).select(
        "ticker", "date", F.col("close").alias("open"), (F.col("close") + 1).alias("high"),
        (F.col("close") - 1).alias("low"), "close", F.col("close").alias("adj_close"), F.lit(1000).cast("bigint").alias("volume"))
    blocked = with_blocks(number_rows(bars), lookback=64, block_rows=256)
    groups = blocked.where("ticker = 'HOT'").select(BLK).distinct().count()
    assert groups == 12  # ceil(3000 / 256)
    plain = indicators.silver_indicators(bars, "plain")
    blk = indicators.silver_indicators(bars, "blocks", block_rows=256)
    num = [c for c, t in plain.dtypes if t in ("double", "bigint")]
    a = plain.select("ticker", "date", *[F.round(c, 8).alias(c) for c in num])
    b = blk.select("ticker", "date", *[F.round(c, 8).alias(c) for c in num])
    assert blk.count() == 3040 and a.exceptAll(b).count() == 0


def test_calendar_numbering_equals_numbering_by_ranges(spark, chain):
    import datetime as dt

    from candela.operators.frames import RN, number_daily_rows, number_rows

    bars = chain[0].select("ticker", "date")
    edge = spark.createDataFrame(
        [("E", dt.date(2020, 12, 31)), ("E", dt.date(2020, 1, 1)), ("E", dt.date(2020, 3, 4)),
         ("E", dt.date(2024, 12, 31)), ("E", dt.date(2021, 5, 6)), ("F", dt.date(1999, 12, 31))],
        "ticker STRING, date DATE")
    for df in (bars, edge):
        a = number_rows(df).select("ticker", "date", RN)
        b = number_daily_rows(df).select("ticker", "date", RN)
        assert a.exceptAll(b).count() == 0 and b.count() == df.count()
