"""Facts: daily ticker performance (F1, F2), weekly (F3) and monthly (F4) summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from candela.functions.scalar import bucket, safe_div
from candela.operators.frames import carried, rolling, rows
from candela.operators.joins import join_dim
from candela.schema import FACT_INDICATORS

# RSI bands of the daily fact.
RSI_SIGNAL_DAILY = [(">", 70, "Overbought"), ("<", 30, "Oversold")]


#: Rows that the daily measures look back.
MEASURES_LOOKBACK = 19


def daily_measures(df: DataFrame, w: WindowSpec) -> DataFrame:
    """intraday return / range, dollar volume, candle colour, volume flag, RSI signal.

    Expects ``open_price high_price low_price close_price volume rsi``.
    ``is_high_volume`` compares with the mean volume of the last 20 rows.
    """
    o, h, lo, c = (F.col(x) for x in ("open_price", "high_price", "low_price", "close_price"))
    return df.withColumns(
        {
            "daily_return_pct": safe_div(c - o, o) * F.lit(100.0),
            "daily_volatility_pct": safe_div(h - lo, o) * F.lit(100.0),
            "dollar_volume": F.col("volume") * c,
            "candle_color": F.when(c > o, "Green").when(c < o, "Red").otherwise("Neutral"),
            "is_high_volume": F.col("volume") > F.avg("volume").over(rows(w, 20)),
            "rsi_signal": bucket("rsi", RSI_SIGNAL_DAILY, "Normal"),
        }
    )


def fact_daily_base(silver: DataFrame, dim_date_df: DataFrame, dim_tickers_df: DataFrame) -> DataFrame:
    """F1 without measures: silver left-joined to both dimensions, 35 columns."""
    dd = dim_date_df.select("date", "date_key")
    dt = dim_tickers_df.select("ticker", "ticker_key")
    j = join_dim(silver, dd, "date", "left")
    j = join_dim(j, dt, "ticker", "left")
    return j.select(
        "date_key",
        "ticker_key",
        F.lit(2).alias("session_id"),
        "date",
        "ticker",
        F.col("open").alias("open_price"),
        F.col("high").alias("high_price"),
        F.col("low").alias("low_price"),
        F.col("close").alias("close_price"),
        "volume",
        *FACT_INDICATORS,
        *carried(j),
    )


def fact_daily(
    silver: DataFrame,
    dim_date_df: DataFrame,
    dim_tickers_df: DataFrame,
    strategy: str = "blocks",
    stamp: bool = False,
) -> DataFrame:
    """``fact_daily_ticker_performance``: base columns, indicators and daily measures."""
    base = fact_daily_base(silver, dim_date_df, dim_tickers_df)
    out = rolling(base, daily_measures, lookback=MEASURES_LOOKBACK, strategy=strategy)
    if stamp:
        out = out.withColumns({"created_timestamp": F.current_timestamp(), "updated_timestamp": F.current_timestamp()})
    return out


# The output column names of the weekly and monthly facts below are the contract.


def _green_red():
    return (
        F.sum(F.when(F.col("candle_color") == "Green", 1).otherwise(0)),
        F.sum(F.when(F.col("candle_color") == "Red", 1).otherwise(0)),
    )


def fact_weekly(fact: DataFrame, year_mode: str = "calendar", stamp: bool = False) -> DataFrame:
    """per ticker and ISO week; open/close are the first/last trading day's prices.

    ``year_mode="calendar"`` groups by calendar year (the reference: the
    last days of December that belong to ISO week 1 merge with January of
    the same year); ``"iso"`` groups by the ISO week-numbering year.
    """
    if year_mode == "calendar":
        year = F.year("date")
    elif year_mode == "iso":
        year = F.extract(F.lit("YEAROFWEEK"), F.col("date"))
    else:
        raise ValueError("year_mode must be 'calendar' or 'iso'")
    green, red = _green_red()
    aggs = [
        F.min_by("open_price", "date").alias("week_open"),
        F.max_by("close_price", "date").alias("week_close"),
        F.max("high_price").alias("week_high"),
        F.min("low_price").alias("week_low"),
        F.sum("volume").alias("week_volume"),
        F.sum("dollar_volume").alias("week_dollar_vol"),
        F.avg("daily_return_pct").alias("avg_daily_return"),
        F.stddev("daily_return_pct").alias("volatility"),
        F.count(F.lit(1)).alias("trading_day"),
        green.alias("green_days"),
        red.alias("red_days"),
    ]
    if stamp:
        aggs.append(F.current_timestamp().alias("created_timestamp"))
    out = fact.groupBy(
        "ticker_key", "ticker", year.alias("year"), F.weekofyear("date").alias("week_of_year")
    ).agg(*aggs)
    return out.withColumn(
        "week_return_pct", safe_div(F.col("week_close") - F.col("week_open"), "week_open") * F.lit(100.0)
    )


def fact_monthly(fact: DataFrame, stamp: bool = False) -> DataFrame:
    """per ticker and calendar month, with first/last trading day prices and last SMAs."""
    aggs = [
        F.min_by("open_price", "date").alias("month_open"),
        F.max_by("close_price", "date").alias("month_close"),
        F.max("high_price").alias("month_high"),
        F.min("low_price").alias("month_low"),
        F.sum("volume").alias("month_volume"),
        F.sum("dollar_volume").alias("month_dollar_volume"),
        F.avg("daily_return_pct").alias("avg_daily_return"),
        F.stddev("daily_return_pct").alias("volatility"),
        F.count(F.lit(1)).alias("trading_days"),
        F.avg("rsi").alias("avg_rsi"),
        F.max_by("sma_20", "date").alias("final_sma_20"),
        F.max_by("sma_50", "date").alias("final_sma_50"),
    ]
    if stamp:
        aggs.append(F.current_timestamp().alias("created_timestamp"))
    out = fact.groupBy("ticker_key", "ticker", F.year("date").alias("year"), F.month("date").alias("month")).agg(*aggs)
    return out.withColumn(
        "month_return_pct", safe_div(F.col("month_close") - F.col("month_open"), "month_open") * F.lit(100.0)
    )
