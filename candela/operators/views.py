"""Analytical views V1-V5 over the star schema.

Date-relative filters take ``as_of`` (a Column, a date or an ISO string;
default ``current_date()``), so results do not depend on the day of the
run in tests. Filters go on the fact's own ``date`` so they reach the scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from candela.functions.scalar import bucket, safe_div
from candela.operators.frames import carried, drop_ghosts, rolling, rows
from candela.operators.joins import join_dim

# Labels and thresholds of the views.
PERFORMANCE_CATEGORY = [(">", 5, "Strong up"), (">", 2, "Up"), (">", -2, "Flat"), (">", -5, "Down")]
RSI_SIGNAL_VIEW = [(">", 70, "Overbought"), ("<", 30, "Oversold")]
SECTOR_STRENGTH = [(">", 2, "Very Strong"), (">", 0.5, "Strong"), (">", -0.5, "Neutral"), (">", -2, "Weak")]
BB_POSITION = [(">", 0.8, "Near Upper BB"), ("<", 0.2, "Near Lower BB")]
RISK_CATEGORY = [("<", 15, "Low risk"), ("<", 25, "Medium risk")]
PERFORMANCE_RATING = [(">", 10, "Excellent"), (">", 5, "Good"), (">", 0, "Positive"), (">", -5, "Slight loss")]
MARKET_SENTIMENT = [(">", 2, "Very bullish"), (">", 1.5, "Bullish"), (">", 0.67, "Neutral"), (">", 0.5, "Bearish")]
VOLATILITY_REGIME = [(">", 3, "High volatility"), (">", 1.5, "Normal volatility")]


def as_of_col(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        return F.lit(as_of.isoformat()[:10]).cast("date")
    return F.lit(str(as_of)).cast("date")


def recent_rows(fact: DataFrame, as_of, days: int) -> DataFrame:
    """Rows of the last ``days`` days; a stored fact's ``year`` partitions are pruned by the implied year."""
    first = F.date_sub(as_of_col(as_of), days)
    recent = fact.where(F.col("date") >= first)
    return recent.where(F.col("year") >= F.year(first)).drop("year") if "year" in fact.columns else recent


def latest_date(df: DataFrame, date_col: str = "date") -> Column:
    """``max(date)`` of ``df`` as a scalar subquery column (no driver round trip)."""
    return df.select(F.max(date_col)).scalar()


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0))


def v_ticker_performance(fact: DataFrame, dim_date_df: DataFrame, dim_tickers_df: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """V1: last ``days`` days per ticker with performance, RSI and volume labels."""
    recent = recent_rows(fact, as_of, days)
    j = join_dim(recent, dim_date_df.select("date_key", "day_name"), "date_key", "left")
    j = join_dim(j, dim_tickers_df.select("ticker_key", "sector", "industry"), "ticker_key", "left")
    return j.select(
        "ticker", "sector", "industry", "date", "day_name", "close_price", "daily_return_pct",
        "volume", "dollar_volume", "rsi", "candle_color",
        bucket("daily_return_pct", PERFORMANCE_CATEGORY, "Strong down").alias("performance_category"),
        bucket("rsi", RSI_SIGNAL_VIEW, "Neutral").alias("rsi_signal"),
        F.when(F.col("is_high_volume"), "High Volume").otherwise("Normal").alias("basic_volume_indicator"),
    )


def v_sector_performance(fact: DataFrame, dim_date_df: DataFrame, dim_tickers_df: DataFrame, as_of=None, days: int = 90) -> DataFrame:
    """V2: per sector and day over the last ``days`` days."""
    recent = recent_rows(fact, as_of, days)
    j = join_dim(recent, dim_date_df.select("date_key", "year", "month", "quarter"), "date_key", "left")
    j = join_dim(j, dim_tickers_df.select("ticker_key", "sector"), "ticker_key", "left")
    r = F.col("daily_return_pct")
    out = j.groupBy("sector", "date", "year", "month", "quarter").agg(
        F.count("ticker").alias("num_stocks"),
        F.avg(r).alias("avg_sector_return"),
        F.sum("dollar_volume").alias("total_dollar_volume"),
        F.avg("rsi").alias("avg_rsi"),
        F.stddev(r).alias("volatility"),
        _count_if(r > 0).alias("gainers"),
        _count_if(r < 0).alias("losers"),
    )
    return out.withColumns(
        {
            "gainer_ratio": safe_div("gainers", "num_stocks"),
            "sector_strength": bucket("avg_sector_return", SECTOR_STRENGTH, "Very weak"),
        }
    )


#: Rows that the screening view looks back.
SCREEN_LOOKBACK = 29


def _screen(df: DataFrame, w: WindowSpec) -> DataFrame:
    return df.withColumn("_vol_avg_30", F.avg("volume").over(rows(w, 30)))


def v_technical_screening(fact: DataFrame, dim_tickers_df: DataFrame, strategy: str = "blocks") -> DataFrame:
    """V3: trend / MACD / band / RSI / volume-spike / mover flags for every row.

    Unlike the reference the output keeps ``date`` so rows are identifiable.
    The end of the chain: ghosts of a blocked fact are dropped here.
    """
    base = fact.select(
        "date", "ticker", "ticker_key", "close_price", "volume", "daily_return_pct", "sma_20", "sma_50",
        "rsi", "macd", "macd_signal", "bbands_pct", "atr", *carried(fact),
    )
    flagged = drop_ghosts(rolling(base, _screen, lookback=SCREEN_LOOKBACK, strategy=strategy))
    j = join_dim(flagged, dim_tickers_df.select("ticker_key", "sector"), "ticker_key", "left")
    c, s20, s50 = F.col("close_price"), F.col("sma_20"), F.col("sma_50")
    return j.select(
        "ticker", "sector", "date", "close_price", "volume", "daily_return_pct", "sma_20", "sma_50",
        "rsi", "macd", "macd_signal", "bbands_pct", "atr",
        F.when((c > s20) & (s20 > s50), "Bullish Trend")
        .when((c < s20) & (s20 < s50), "Bearish Trend")
        .otherwise("Sideways")
        .alias("trend_signal"),
        F.when(F.col("macd") > F.col("macd_signal"), "MACD Bullish").otherwise("MACD Bearish").alias("basic_macd_signal"),
        bucket("bbands_pct", BB_POSITION, "BB Middle").alias("bb_position"),
        (F.col("rsi") < 30).alias("oversold_flag"),
        (F.col("rsi") > 70).alias("overbought_flag"),
        (F.col("volume") > F.col("_vol_avg_30") * 2).alias("volume_spike_flag"),
        (F.col("daily_return_pct") > 5).alias("strong_mover_flag"),
    )


def v_risk_metrics(monthly: DataFrame, dim_tickers_df: DataFrame, as_of=None) -> DataFrame:
    """V4: monthly risk / return labels from the year of ``as_of - 365 days`` on."""
    recent = monthly.where(F.col("year") >= F.year(F.date_sub(as_of_col(as_of), 365)))
    j = join_dim(recent, dim_tickers_df.select("ticker_key", "sector"), "ticker_key", "left")
    return j.select(
        "ticker", "sector", "year", "month", "month_return_pct",
        F.col("volatility").alias("month_volatility"),
        "avg_daily_return", "trading_days",
        safe_div("month_return_pct", "volatility").alias("risk_adjusted_return"),
        bucket("volatility", RISK_CATEGORY, "High risk").alias("risk_category"),
        bucket("month_return_pct", PERFORMANCE_RATING, "Poor").alias("performance_rating"),
    )


def v_kpi_daily_market_health(fact: DataFrame, strict: bool = True, stamp: bool = False) -> DataFrame:
    """V5: market breadth and sentiment per day (one hash aggregate on date).

    ``strict=True`` keeps the reference label for a day without losers
    (ratio NULL -> "Very bearish"); ``strict=False`` labels it "Very bullish".
    """
    r, rsi_ = F.col("daily_return_pct"), F.col("rsi")
    aggs = [
        F.count("ticker").alias("total_stocks_traded"),
        F.sum("dollar_volume").alias("total_market_volume"),
        F.avg(r).alias("market_avg_return"),
        F.stddev(r).alias("market_volatility"),
        _count_if(r > 0).alias("gainers"),
        _count_if(r < 0).alias("losers"),
        _count_if(r == 0).alias("unchanged"),
        F.avg(rsi_).alias("avg_market_rsi"),
        _count_if(rsi_ > 70).alias("overbought_count"),
        _count_if(rsi_ < 30).alias("oversold_count"),
        _count_if(F.col("is_high_volume")).alias("high_volume_count"),
        _count_if(r > 5).alias("strong_gainers"),
        _count_if(r < -5).alias("strong_losers"),
    ]
    if stamp:
        aggs.append(F.current_timestamp().alias("calculated_timestamp"))
    return with_health_labels(fact.groupBy("date").agg(*aggs), strict)


def with_health_labels(out: DataFrame, strict: bool = True) -> DataFrame:
    """Ratio, sentiment and volatility labels of the daily counts."""
    out = out.withColumn("advance_decline_ratio", safe_div("gainers", "losers"))
    sentiment = bucket("advance_decline_ratio", MARKET_SENTIMENT, "Very bearish")
    if not strict:
        sentiment = F.when((F.col("losers") == 0) & (F.col("gainers") > 0), "Very bullish").otherwise(sentiment)
    return out.withColumns(
        {
            "market_sentiment": sentiment,
            "volatility_regime": bucket("market_volatility", VOLATILITY_REGIME, "Low volatility"),
        }
    )
