"""Mergeable partial states of the summary facts and daily KPIs (F3, F4, V5), and mergeable distinct counts (Q3, V5).

A summary is a set of measures over groups. Each measure has a state that
two batches of rows can be reduced to apart and that merges without the
rows: counts and sums add up, extremes compare, the first and last value
travel with their date, and mean and variance are kept as (n, mean, M2) and
merged by Chan's formula, which does not cancel as sums of squares do.
So an append of new daily rows costs one aggregate over the batch and one
merge per touched group, not a rescan of the fact.

``partial`` reduces rows to states, ``merge`` brings two tables of states
together (each with at most one state per group), ``finish`` gives the
columns of the one-pass operators in :mod:`candela.operators.facts` and
:mod:`candela.operators.views`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.functions.scalar import safe_div
from candela.operators import views
from candela.operators.frames import RN, number_rows

#: Kinds of measures: what they keep, by suffix.
SUM, COUNT, LEAST, GREATEST, FIRST, LAST, MEAN, MOMENTS = "sum", "count", "least", "greatest", "first", "last", "mean", "moments"


@dataclass(frozen=True)
class Summary:
    """Groups and measures: ``keys`` by name, ``measures`` as name -> (kind, input), and the columns made of the states."""

    keys: Mapping[str, Column]
    measures: Mapping[str, tuple[str, Column]]
    finish: Callable[[DataFrame], DataFrame]
    order: str = "date"


def _state(name: str, kind: str, value: Column, order: str) -> list[Column]:
    n = F.count(value)
    if kind in (SUM, COUNT):
        return [(F.sum(value) if kind == SUM else n).alias(name)]
    if kind in (LEAST, GREATEST):
        return [(F.min(value) if kind == LEAST else F.max(value)).alias(name)]
    if kind == FIRST:
        return [F.min_by(value, order).alias(name), F.min(order).alias(f"{name}_at")]
    if kind == LAST:
        return [F.max_by(value, order).alias(name), F.max(order).alias(f"{name}_at")]
    mean = [n.alias(f"{name}_n"), F.avg(value).alias(f"{name}_mean")]
    return mean if kind == MEAN else [*mean, (F.var_pop(value) * n).alias(f"{name}_m2")]


def partial(rows: DataFrame, summary: Summary) -> DataFrame:
    """One state per group of ``rows`` (map-side partial aggregation, one shuffle of states)."""
    keys = [c.alias(k) for k, c in summary.keys.items()]
    states = [c for name, (kind, value) in summary.measures.items() for c in _state(name, kind, value, summary.order)]
    return rows.groupBy(*keys).agg(*states)


def _merged(name: str, kind: str) -> list[Column]:
    """The state of two states. NULLs (a measure without a value in one of them) count as nothing."""
    if kind in (SUM, COUNT):
        return [F.sum(name).alias(name)]
    if kind in (LEAST, GREATEST):
        return [(F.min(name) if kind == LEAST else F.max(name)).alias(name)]
    if kind in (FIRST, LAST):
        by, edge = (F.min_by, F.min) if kind == FIRST else (F.max_by, F.max)
        return [by(name, f"{name}_at").alias(name), edge(f"{name}_at").alias(f"{name}_at")]
    n, mean = F.col(f"{name}_n"), F.col(f"{name}_mean")
    total = F.sum(n)
    out = [total.alias(f"{name}_n"), safe_div(F.sum(n * mean), total).alias(f"{name}_mean")]
    if kind == MOMENTS:  # of two states: M2 = M2a + M2b + (mean a - mean b)^2 * na * nb / n, with 2 na nb = n^2 - na^2 - nb^2
        pair = safe_div(total * total - F.sum(n * n), 2 * total)
        apart = F.max(mean) - F.min(mean)
        out.append((F.sum(f"{name}_m2") + F.coalesce(apart * apart * pair, F.lit(0.0))).alias(f"{name}_m2"))
    return out


def merge(a: DataFrame, b: DataFrame, summary: Summary) -> DataFrame:
    """The states of both tables; each holds at most one per group (so at most two meet)."""
    states = [c for name, (kind, _) in summary.measures.items() for c in _merged(name, kind)]
    return a.unionByName(b).groupBy(*summary.keys).agg(*states)


def deviation(name: str) -> Column:
    """Sample standard deviation of a MOMENTS measure (NULL for one value, as ``stddev``)."""
    n = F.col(f"{name}_n")
    return F.when(n > 1, F.sqrt(F.col(f"{name}_m2") / (n - 1)))


def _count_if(condition: Column) -> tuple[str, Column]:
    return SUM, F.when(condition, 1).otherwise(0)


def _with_return(states: DataFrame, unit: str) -> DataFrame:
    return states.withColumn(
        f"{unit}_return_pct", safe_div(F.col(f"{unit}_close") - F.col(f"{unit}_open"), f"{unit}_open") * F.lit(100.0)
    )


def weekly(year_mode: str = "calendar") -> Summary:
    """F3 (see :func:`candela.operators.facts.fact_weekly`)."""
    years = {"calendar": F.year("date"), "iso": F.extract(F.lit("YEAROFWEEK"), F.col("date"))}
    color = F.col("candle_color")
    return Summary(
        {"ticker_key": F.col("ticker_key"), "ticker": F.col("ticker"), "year": years[year_mode], "week_of_year": F.weekofyear("date")},
        {
            "week_open": (FIRST, F.col("open_price")), "week_close": (LAST, F.col("close_price")),
            "week_high": (GREATEST, F.col("high_price")), "week_low": (LEAST, F.col("low_price")),
            "week_volume": (SUM, F.col("volume")), "week_dollar_vol": (SUM, F.col("dollar_volume")),
            "ret": (MOMENTS, F.col("daily_return_pct")), "trading_day": (COUNT, F.lit(1)),
            "green_days": _count_if(color == "Green"), "red_days": _count_if(color == "Red"),
        },
        lambda s: _with_return(s, "week").select(
            "ticker_key", "ticker", "year", "week_of_year", "week_open", "week_close", "week_high", "week_low", "week_volume",
            "week_dollar_vol", F.col("ret_mean").alias("avg_daily_return"), deviation("ret").alias("volatility"), "trading_day",
            "green_days", "red_days", "week_return_pct",
        ),
    )


def monthly() -> Summary:
    """F4 (see :func:`candela.operators.facts.fact_monthly`)."""
    return Summary(
        {"ticker_key": F.col("ticker_key"), "ticker": F.col("ticker"), "year": F.year("date"), "month": F.month("date")},
        {
            "month_open": (FIRST, F.col("open_price")), "month_close": (LAST, F.col("close_price")),
            "month_high": (GREATEST, F.col("high_price")), "month_low": (LEAST, F.col("low_price")),
            "month_volume": (SUM, F.col("volume")), "month_dollar_volume": (SUM, F.col("dollar_volume")),
            "ret": (MOMENTS, F.col("daily_return_pct")), "trading_days": (COUNT, F.lit(1)), "rsi": (MEAN, F.col("rsi")),
            "final_sma_20": (LAST, F.col("sma_20")), "final_sma_50": (LAST, F.col("sma_50")),
        },
        lambda s: _with_return(s, "month").select(
            "ticker_key", "ticker", "year", "month", "month_open", "month_close", "month_high", "month_low", "month_volume",
            "month_dollar_volume", F.col("ret_mean").alias("avg_daily_return"), deviation("ret").alias("volatility"), "trading_days",
            F.col("rsi_mean").alias("avg_rsi"), "final_sma_20", "final_sma_50", "month_return_pct",
        ),
    )


def daily_health() -> Summary:
    """V5 (see :func:`candela.operators.views.v_kpi_daily_market_health`), for days whose rows arrive in several batches."""
    r, rsi = F.col("daily_return_pct"), F.col("rsi")
    counts = {
        "gainers": r > 0, "losers": r < 0, "unchanged": r == 0, "overbought_count": rsi > 70, "oversold_count": rsi < 30,
        "high_volume_count": F.col("is_high_volume"), "strong_gainers": r > 5, "strong_losers": r < -5,
    }
    return Summary(
        {"date": F.col("date"), "year": F.year("date")},
        {
            "total_stocks_traded": (COUNT, F.col("ticker")), "total_market_volume": (SUM, F.col("dollar_volume")),
            "ret": (MOMENTS, r), "rsi": (MEAN, rsi), **{name: _count_if(c) for name, c in counts.items()},
        },
        lambda s: views.with_health_labels(s.select(
            "date", "total_stocks_traded", "total_market_volume", F.col("ret_mean").alias("market_avg_return"),
            deviation("ret").alias("market_volatility"), "gainers", "losers", "unchanged", F.col("rsi_mean").alias("avg_market_rsi"),
            "overbought_count", "oversold_count", "high_volume_count", "strong_gainers", "strong_losers",
        )),
    )


# -- distinct tickers as bitmaps ------------------------------------------------


def dense_ids(names: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(ticker, id): ids 0, 1, 2, ... without gaps; those of ``known`` stay, new names follow them in order.

    NULL has no id: a distinct count leaves it out. New names are numbered by
    ranges (:func:`frames.number_rows`), not in one task.
    """
    new = names.select("ticker").where(F.col("ticker").isNotNull()).distinct()
    start = F.lit(0)
    if known is not None:
        new = new.join(known, "ticker", "left_anti")
        start = F.lit(known.agg(F.coalesce(F.max("id") + 1, F.lit(0)).alias("n")).first()["n"])
    one_series = new.withColumn("_all", F.lit(0))
    ids = number_rows(one_series, "_all", "ticker").select("ticker", (F.col(RN) - 1 + start).cast("long").alias("id"))
    return ids if known is None else known.select("ticker", "id").unionByName(ids)


def ticker_bitmaps(rows: DataFrame, ids: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, bucket, bits): the tickers of each group as bitmaps of up to 32,768 ids each."""
    placed = rows.select(*keys, "ticker").join(ids, "ticker")
    return placed.groupBy(*keys, F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits")
    )


def merge_bitmaps(bitmaps: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """Bitmaps of wider groups (days to months, or several batches), by OR."""
    return bitmaps.groupBy(*[c.alias(k) for k, c in keys.items()], "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_tickers(bitmaps: DataFrame, keys: Sequence[str], name: str = "unique_tickers") -> DataFrame:
    """Exact distinct counts of the groups."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))
