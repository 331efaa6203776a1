"""Spark side of the query registry: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query runs the library's own operators over bars derived from the
whole test tables (``candela.sources.tpch_bars``) and normalises its output
for comparison with the SQL oracle: floating-point columns go through
``round4``, 32-bit integers widen to BIGINT, and hash keys / run timestamps
are left out.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.checks.oracle import INDICATOR_COLUMNS, MONEY_SUMS, YEAR_FLOOR
from candela.functions.scalar import round4, round_to
from candela.operators import dims, facts, frames, indicators, quality, views
from candela.operators.views import latest_date
from candela.session import scratch_dir
from candela.sources.staging import broken_bars
from candela.sources.tpch_bars import load_bars, load_ticker_metadata

# Fixed stamp for the ticker change feed in checks (any constant works).
CHECK_TIME = _dt.datetime(2025, 1, 1)


def check_stamp():
    return F.lit(CHECK_TIME).cast("timestamp")

DROP = ("ticker_key", "modified_date", "created_timestamp", "updated_timestamp", "calculated_timestamp")


def norm(df: DataFrame) -> DataFrame:
    """Round doubles (tie-safe: 4 places, cents for summed dollar volumes), widen small ints,
    drop keys and stamps."""
    out = []
    for f in df.schema.fields:
        if f.name in DROP:
            continue
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            rounded = round_to(f.name, 2) if f.name in MONEY_SUMS else round4(f.name)
            out.append(rounded.alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            out.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def stored_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bars written once under the checkpoint folder (as the pipeline stores them): the line items are read once."""
    path = scratch_dir(spark, "star-bars")
    bars = load_bars(spark, sf_dir)
    bars.write.parquet(path)
    return spark.read.schema(bars.schema).parquet(path)


class Star:
    """The star schema of one scale-factor directory.

    The bars are stored once (:func:`stored_bars`). With
    ``strategy="blocks"`` the rows are numbered and cut once for the whole
    chain bars -> indicators -> fact -> screening, which carries the blocks.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, strategy: str = "blocks"):
        self.bars = stored_bars(spark, sf_dir)
        self.meta = load_ticker_metadata(spark, sf_dir)
        self.strategy = strategy

    @property
    def _chain_bars(self) -> DataFrame:
        if self.strategy == "plain":
            return self.bars
        return frames.block_once(self.bars, indicators.silver_lookback() + facts.MEASURES_LOOKBACK + views.SCREEN_LOOKBACK)

    @property
    def _chain_fact(self) -> DataFrame:
        silver = indicators.silver_indicators(self._chain_bars, self.strategy)
        return facts.fact_daily(silver, self.dim_date, self.dim_tickers, strategy=self.strategy)

    @property
    def silver(self) -> DataFrame:
        return indicators.silver_indicators(self.bars, self.strategy)

    @property
    def dim_date(self) -> DataFrame:
        return dims.dim_date(self.bars)

    @property
    def dim_tickers(self) -> DataFrame:
        return dims.dim_tickers_source(self.bars, self.meta, modified=check_stamp())

    @property
    def fact(self) -> DataFrame:
        return frames.drop_ghosts(self._chain_fact)

    @property
    def screening(self) -> DataFrame:
        return views.v_technical_screening(self._chain_fact, self.dim_tickers, strategy=self.strategy)

    @property
    def monthly(self) -> DataFrame:
        return facts.fact_monthly(self.fact)

    @property
    def as_of(self):
        return latest_date(self.bars)


# --- sources ---------------------------------------------------------------

def q_bars(spark, sf):
    return norm(load_bars(spark, sf))


def q_dedup_bars(spark, sf):
    from candela.operators.dedup import dedup_bars
    from candela.sources.staging import bars_with_stale_copies

    return norm(dedup_bars(bars_with_stale_copies(load_bars(spark, sf))))


# --- indicators ------------------------------------------------------------

_IND_NAME = {
    "ind_sma": "sma", "ind_ema_compat": "ema_seeded", "ind_macd": "macd", "ind_bbands": "bollinger_bands",
    "ind_atr": "atr", "ind_rsi": "rsi", "ind_stochastic": "stochastic", "ind_cci": "cci", "ind_mfi": "mfi",
    "ind_obv": "obv", "ind_adl": "adl", "ind_support_resistance": "support_resistance",
}


def _indicator_query(key: str):
    def run(spark, sf):
        out = indicators.indicator(stored_bars(spark, sf), _IND_NAME[key])
        return norm(out.select("ticker", "date", *INDICATOR_COLUMNS[key]))

    run.__name__ = f"q_{key}"
    return run


def q_ind_text_order(spark, sf):
    """The moving averages of bars whose order is a text (rows numbered by sampled ranges)."""
    bars = stored_bars(spark, sf).withColumn("day", F.date_format("date", "yyyy-MM-dd"))
    out = indicators.run_indicators(bars.drop("date"), ["sma"], order="day")
    return norm(out.select("ticker", F.col("day").cast("date").alias("date"), *INDICATOR_COLUMNS["ind_sma"]))


def q_ind_ema(spark, sf):
    from candela.operators.ema import ema

    return norm(ema(stored_bars(spark, sf)).select("ticker", "date", "ema_12"))


def q_ind_chain(spark, sf):
    """Fluent chain: two EMAs by repeated calls, positional arguments, and an SMA over the RSI."""
    chain = indicators.IndicatorChain(stored_bars(spark, sf), "ticker", "date")
    out = chain.ema(span=12).ema(span=26, out_col="ema_26").sma("close", [5]).rsi().sma(col="rsi", periods=[3]).get_df()
    return norm(out.select("ticker", "date", "ema_12", "ema_26", "sma_5", "rsi", "sma_3"))


def q_ind_macd_ema(spark, sf):
    """T3 with recursive EMA legs."""
    out = indicators.IndicatorChain(stored_bars(spark, sf), "ticker", "date").macd(kind="ema").get_df()
    return norm(out.select("ticker", "date", "ema_fast", "ema_slow", "macd", "macd_signal", "macd_gap"))


def q_silver(spark, sf):
    return norm(Star(spark, sf).silver)


def q_silver_plain(spark, sf):
    return norm(Star(spark, sf, strategy="plain").silver)


# --- quality ---------------------------------------------------------------

def _silver_rules():
    return quality.silver_rules(YEAR_FLOOR)


def q_expect_silver(spark, sf):
    """Failures of every silver rule, over bars of which some break each rule."""
    return quality.violation_counts(broken_bars(load_bars(spark, sf)), _silver_rules())


def q_expect_drop(spark, sf):
    return norm(quality.expect_all(broken_bars(load_bars(spark, sf)), _silver_rules(), mode="drop"))


def q_expect_fact(spark, sf):
    """Failures of every fact rule, over a fact of which some rows break each rule."""
    return quality.violation_counts(broken_bars(Star(spark, sf).fact, "close_price"), quality.FACT_RULES)


def q_data_quality(spark, sf):
    return norm(quality.data_quality_metrics(Star(spark, sf).fact))


# --- dimensions ------------------------------------------------------------

def q_dim_date(spark, sf):
    return norm(Star(spark, sf).dim_date)


def q_dim_tickers_source(spark, sf):
    return norm(Star(spark, sf).dim_tickers)


def q_market_cap_category(spark, sf):
    dt = Star(spark, sf).dim_tickers
    return dt.groupBy("market_cap_category").agg(
        F.count(F.lit(1)).alias("tickers"), F.sum("market_cap").alias("total_market_cap")
    )


# --- joins and facts -------------------------------------------------------

def q_left_join_dim_date(spark, sf):
    s = Star(spark, sf)
    from candela.operators.joins import join_dim

    j = join_dim(s.bars, s.dim_date, "date", "left")
    return norm(j.select("ticker", "date", "date_key", "year", "week_of_year", "day_name", "close"))


def q_left_join_dim_ticker(spark, sf):
    s = Star(spark, sf)
    from candela.operators.joins import join_dim

    j = join_dim(s.bars, s.dim_tickers, "ticker", "left")
    return norm(j.select("ticker", "date", "sector", "market_cap_category", "currency", "close"))


def q_daily_measures(spark, sf):
    f = Star(spark, sf).fact
    return norm(f.select("ticker", "date", "daily_return_pct", "daily_volatility_pct", "dollar_volume",
                         "candle_color", "is_high_volume", "rsi_signal"))


def q_fact_daily(spark, sf):
    return norm(Star(spark, sf).fact)


def q_fact_weekly(spark, sf):
    return norm(facts.fact_weekly(Star(spark, sf).fact))


def q_fact_weekly_iso(spark, sf):
    return norm(facts.fact_weekly(Star(spark, sf).fact, year_mode="iso"))


def q_fact_monthly(spark, sf):
    return norm(Star(spark, sf).monthly)


# --- views -----------------------------------------------------------------

def q_v_ticker_performance(spark, sf):
    s = Star(spark, sf)
    return norm(views.v_ticker_performance(s.fact, s.dim_date, s.dim_tickers, as_of=s.as_of))


def q_v_sector_performance(spark, sf):
    s = Star(spark, sf)
    return norm(views.v_sector_performance(s.fact, s.dim_date, s.dim_tickers, as_of=s.as_of))


def q_v_technical_screening(spark, sf):
    s = Star(spark, sf)
    return norm(s.screening)


def q_v_risk_metrics(spark, sf):
    s = Star(spark, sf)
    return norm(views.v_risk_metrics(s.monthly, s.dim_tickers, as_of=s.as_of))


def q_v_kpi(spark, sf):
    return norm(views.v_kpi_daily_market_health(Star(spark, sf).fact))


QUERIES = {
    "bars_fixture": q_bars,
    "dedup_bars": q_dedup_bars,
    **{k: _indicator_query(k) for k in INDICATOR_COLUMNS},
    "ind_text_order": q_ind_text_order,
    "ind_ema": q_ind_ema,
    "ind_chain": q_ind_chain,
    "ind_macd_ema": q_ind_macd_ema,
    "silver_ticker_indicators": q_silver,
    "silver_ticker_indicators_plain": q_silver_plain,
    "expect_silver": q_expect_silver,
    "expect_drop": q_expect_drop,
    "expect_fact": q_expect_fact,
    "data_quality_metrics": q_data_quality,
    "dim_date": q_dim_date,
    "dim_tickers_source": q_dim_tickers_source,
    "market_cap_category": q_market_cap_category,
    "left_join_dim_date": q_left_join_dim_date,
    "left_join_dim_ticker": q_left_join_dim_ticker,
    "daily_measures": q_daily_measures,
    "fact_daily": q_fact_daily,
    "fact_weekly": q_fact_weekly,
    "fact_weekly_iso": q_fact_weekly_iso,
    "fact_monthly": q_fact_monthly,
    "v_ticker_performance": q_v_ticker_performance,
    "v_sector_performance": q_v_sector_performance,
    "v_technical_screening": q_v_technical_screening,
    "v_risk_metrics": q_v_risk_metrics,
    "v_kpi_daily_market_health": q_v_kpi,
}

