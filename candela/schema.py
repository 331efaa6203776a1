"""Schemas and column lists shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw bar file layout: columns bind by position (the header names differ).
RAW_BAR = T.StructType(
    [
        T.StructField("date", T.StringType(), True),
        T.StructField("open", T.DoubleType(), True),
        T.StructField("high", T.DoubleType(), True),
        T.StructField("low", T.DoubleType(), True),
        T.StructField("close", T.DoubleType(), True),
        T.StructField("adj_close", T.DoubleType(), True),
        T.StructField("volume", T.LongType(), True),
    ]
)

BAR_COLUMNS = ["ticker", "date", "open", "high", "low", "close", "adj_close", "volume"]

# Ticker metadata as the enrichment step expects it.
TICKER_META_DDL = (
    "ticker STRING, company_name STRING, sector STRING, industry STRING, market_cap LONG, "
    "market_cap_category STRING, country STRING, currency STRING, exchange STRING"
)

# The contract's column names and their order.
# Indicator output columns carried into the daily fact, in order.
FACT_INDICATORS = [
    "sma_5", "sma_15", "sma_20", "sma_30", "sma_50", "ema_12",
    "macd", "macd_signal", "macd_gap",
    "bbands_sma", "bbands_upper", "bbands_lower", "bbands_width", "bbands_pct",
    "atr", "rsi", "stoch_signal", "cci", "obv", "adl", "mfi",
    "resistance", "support", "distance_to_resistance", "distance_to_support",
]

# Longest look-back (in rows) any indicator chain of the silver stage needs:
# SMA-50 / A/D need 49, OBV 50 (49 + lag), MACD signal 33, CCI 38, stochastic 26.
SILVER_LOOKBACK = 64
