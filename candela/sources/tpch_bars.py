"""Daily bars and ticker metadata derived from the TPC-H-style tables.

The test tables hold no market data, so bars are formed from line items:
one bar per (nation of the supplier, ship date). The price of a line is
``extendedprice / quantity``; open and close are the prices of the first
and last line in a total order over the line's identifying columns; high
and low widen the price by tax and discount; volume is the summed quantity.

Everything here is two joins plus one aggregate; all aggregates are
decomposable (min/max over a struct, sums), so map-side partial
aggregation collapses even a hot (nation, day) group before the shuffle.

Both joins are left to the planner's size check (file statistics against
``autoBroadcastJoinThreshold``); beyond it the line items are shuffle-joined
to suppliers and AQE splits a hot supplier key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.functions.scalar import safe_div
from candela.sources.tables import read_table


def bars_from_lineitem(lineitem: DataFrame, supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Bars ``ticker, date, open, high, low, close, adj_close, volume``."""
    nat = nation.select("n_nationkey", "n_name")
    sup = supplier.select("s_suppkey", "s_nationkey").join(
        nat, F.col("s_nationkey") == F.col("n_nationkey")
    ).select("s_suppkey", F.col("n_name").alias("ticker"))
    li = lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
    )
    px = safe_div("l_extendedprice", "l_quantity")
    lines = (
        li.join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            "ticker",
            F.to_date("l_shipdate").alias("date"),
            px.alias("px"),
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            "l_quantity", "l_discount", "l_tax",
        )
    )
    key = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "px")
    bars = lines.groupBy("ticker", "date").agg(
        F.min_by("px", key).alias("open"),
        F.max(F.col("px") * (F.lit(1) + F.col("l_tax"))).alias("high"),
        F.min(F.col("px") * (F.lit(1) - F.col("l_discount"))).alias("low"),
        F.max_by("px", key).alias("close"),
        F.sum(F.col("l_quantity").cast("bigint")).cast("bigint").alias("volume"),
    )
    return bars.select(
        "ticker", "date", "open", "high", "low", "close",
        F.col("close").alias("adj_close"), "volume",
    )


def ticker_metadata_from_tpch(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """One metadata row per nation: sector = region name, market cap from supplier balances.

    Attributes the tables do not carry (industry, currency, exchange) stay
    NULL so that the enrichment step's defaults apply.
    """
    cap = supplier.groupBy("s_nationkey").agg(F.sum("s_acctbal").alias("acct"))
    nr = nation.join(
        region.select("r_regionkey", "r_name"),
        F.col("n_regionkey") == F.col("r_regionkey"),
        "left",
    )
    joined = nr.join(cap, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    market_cap = F.greatest(
        F.lit(0).cast("bigint"),
        F.round(F.coalesce(F.col("acct"), F.lit(0.0)) * F.lit(1e6)).cast("bigint"),
    )
    return joined.select(
        F.col("n_name").alias("ticker"),
        F.col("n_name").alias("company_name"),
        F.col("r_name").alias("sector"),
        F.lit(None).cast("string").alias("industry"),
        market_cap.alias("market_cap"),
        F.col("n_name").alias("country"),
        F.lit(None).cast("string").alias("currency"),
        F.lit(None).cast("string").alias("exchange"),
    )


def load_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_from_lineitem(
        read_table(spark, sf_dir, "lineitem"),
        read_table(spark, sf_dir, "supplier"),
        read_table(spark, sf_dir, "nation"),
    )


def load_ticker_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticker_metadata_from_tpch(
        read_table(spark, sf_dir, "supplier"),
        read_table(spark, sf_dir, "nation"),
        read_table(spark, sf_dir, "region"),
    )
