"""Ticker metadata as a file source (re-aims the per-ticker lookup of the reference).

The reference fetched each ticker's profile over HTTP on the driver; here
the profiles are a table (CSV with a header, JSON lines or Parquet) read
with the fixed metadata schema and joined to the distinct tickers by
:func:`candela.operators.dims.dim_tickers_source`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candela.schema import TICKER_META_DDL


def read_ticker_metadata(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    reader = spark.read.schema(TICKER_META_DDL)
    if fmt == "csv":
        return reader.option("header", True).csv(path)
    if fmt == "json":
        return reader.json(path)
    if fmt == "parquet":
        return reader.parquet(path)
    raise ValueError("fmt must be csv, json or parquet")


def empty_ticker_metadata(spark: SparkSession) -> DataFrame:
    """An empty, typed metadata table (every ticker then takes the defaults)."""
    return spark.createDataFrame([], TICKER_META_DDL)
