"""Query name -> Spark callable and query name -> oracle SQL."""

from __future__ import annotations

from candela.checks import oracle as O
from candela.checks.queries import QUERIES
from candela.checks.streams import STREAM_QUERIES, stream_oracle_sql


def oracle_sql() -> dict[str, str]:
    bars = f"{O.with_(O.BARS)} {O.bars_select()}"
    sql = {
        "bars_fixture": bars,
        "dedup_bars": bars,
        **{k: O.indicator_sql(k) for k in O.INDICATOR_COLUMNS},
        "ind_text_order": O.indicator_sql("ind_sma"),
        "ind_ema": O.ema_recursive_sql(),
        "ind_chain": O.ind_chain_sql(),
        "ind_macd_ema": O.macd_ema_sql(),
        "silver_ticker_indicators": O.silver_sql(),
        "silver_ticker_indicators_plain": O.silver_sql(),
        "expect_silver": O.expect_silver_sql(),
        "expect_drop": O.expect_drop_sql(),
        "expect_fact": O.expect_fact_sql(),
        "data_quality_metrics": O.data_quality_sql(),
        "dim_date": O.dim_date_sql(),
        "dim_tickers_source": O.dim_tickers_sql(),
        "market_cap_category": O.market_cap_category_sql(),
        "left_join_dim_date": O.left_join_dim_date_sql(),
        "left_join_dim_ticker": O.left_join_dim_ticker_sql(),
        "daily_measures": O.daily_measures_sql(),
        "fact_daily": O.fact_sql(),
        "fact_weekly": O.weekly_sql(),
        "fact_weekly_iso": O.weekly_sql(iso=True),
        "fact_monthly": O.monthly_sql(),
        "v_ticker_performance": O.v_ticker_performance_sql(),
        "v_sector_performance": O.v_sector_performance_sql(),
        "v_technical_screening": O.v_technical_screening_sql(),
        "v_risk_metrics": O.v_risk_metrics_sql(),
        "v_kpi_daily_market_health": O.v_kpi_sql(),
    }
    sql.update(stream_oracle_sql())
    return {k: v for k, v in sql.items() if k in queries()}


def queries():
    return {**QUERIES, **STREAM_QUERIES}
