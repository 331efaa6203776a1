"""candela: OHLCV market-bar analytics on open-source Spark.

Pure DataFrame functions for ingest, data quality, rolling technical
indicators, a star schema (date and ticker dimensions, daily / weekly /
monthly facts) and analytical views, plus Structured Streaming jobs for
incremental ingest and SCD type 1 upserts.
"""

__version__ = "0.1.0"
