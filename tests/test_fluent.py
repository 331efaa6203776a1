"""Fluent chain, parameterised look-back, order types."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from candela.operators import indicators
from candela.operators.indicators import CHAIN, IndicatorChain, reach
from candela.sources.tpch_bars import load_bars
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def bars(spark):
    return load_bars(spark, SF_SMALL).cache()


def _same(a, b):
    num = [c for c, t in a.dtypes if t in ("double", "bigint")]
    x = a.select("ticker", "date", *[F.round(c, 8).alias(c) for c in num])
    y = b.select("ticker", "date", *[F.round(c, 8).alias(c) for c in num])
    return a.count() == b.count() and x.exceptAll(y).count() == 0


def test_chain_equals_silver(bars):
    chain = IndicatorChain(bars, "ticker", "date", strategy="plain")
    for name in ("sma", "ema", "macd", "bollinger_bands", "atr", "rsi", "stochastic", "cci", "mfi", "obv",
                 "adl", "support_resistance"):
        chain = getattr(chain, name)()
    out = chain.get_df()
    silver = indicators.silver_indicators(bars, "plain")
    assert out.columns == silver.columns
    assert _same(out, silver)


def test_reach_of_defaults():
    assert reach(CHAIN) == 50
    assert reach(["sma"], {"sma": {"periods": [200]}}) == 199


def test_long_custom_period_stays_exact_with_blocks(bars):
    plain = IndicatorChain(bars, "ticker", "date", strategy="plain").sma(periods=[120]).obv(period=90).get_df()
    blk = IndicatorChain(bars, "ticker", "date", strategy="blocks", block_rows=130).sma(periods=[120]).obv(
        period=90).get_df()
    assert _same(plain, blk)


def test_strategy_is_an_explicit_choice(bars):
    with pytest.raises(ValueError):
        indicators.silver_indicators(bars, "auto")


def test_calls_repeat_take_positions_and_chain(spark, bars):
    for strategy, block_rows in (("plain", None), ("blocks", 70)):
        chain = IndicatorChain(bars, "ticker", "date", strategy=strategy, block_rows=block_rows)
        out = chain.ema(span=12).ema("close", 26, "ema_26").sma("close", [5]).rsi().sma(col="rsi", periods=[3]).sma("sma_3", [2]).get_df()
        w = Window.partitionBy("ticker").orderBy("date")
        want = IndicatorChain(bars, "ticker", "date", strategy="plain").rsi().get_df()
        want = want.withColumn("x", F.avg("rsi").over(w.rowsBetween(-2, 0))).withColumn("y", F.avg("x").over(w.rowsBetween(-1, 0)))
        both = out.join(want.select("ticker", "date", "x", "y"), ["ticker", "date"])
        assert both.where("NOT (abs(sma_3 - x) < 1e-9 OR (sma_3 IS NULL AND x IS NULL))").isEmpty()
        assert both.where("NOT (abs(sma_2 - y) < 1e-9 OR (sma_2 IS NULL AND y IS NULL))").isEmpty()
        assert {"ema_12", "ema_26", "sma_5"} <= set(out.columns)
    with pytest.raises(ValueError):
        IndicatorChain(bars, "ticker", "date").macd(kind="other")


def test_number_and_time_orders_under_blocks(spark):
    for kind in ("int", "double", "timestamp", "string"):
        rows = spark.range(400).select(
            (F.col("id") % 2).cast("string").alias("ticker"), F.col("id").cast("int").alias("n"), (F.col("id") * 7 % 31).cast("double").alias("close"),
        )
        order = {"int": F.col("n") * 1000, "double": F.col("n") / 3, "timestamp": F.timestamp_seconds(F.col("n") * 400_000),
                 "string": F.lpad(F.col("n").cast("string"), 5, "0")}[kind]
        rows = rows.withColumn("date", F.when(F.col("n") < 2, None).otherwise(order))
        blocks = IndicatorChain(rows, "ticker", "date", strategy="blocks", block_rows=13).sma("close", [5, 9]).get_df()
        plain = IndicatorChain(rows, "ticker", "date", strategy="plain").sma("close", [5, 9]).get_df()
        assert _same(blocks, plain), kind
