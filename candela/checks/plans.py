"""Print the physical plans of the headline queries over stored inputs.

Usage: ``python -m candela.checks.plans [sf_dir] > docs/PLANS.md``
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

from pyspark.sql import functions as F

from candela.operators import dims, facts, frames, indicators, views
from candela.operators.ema import ema, macd_ema
from candela.session import local_session, scratch_dir
from candela.sources.tpch_bars import load_bars, load_ticker_metadata


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def digest(name: str, df, note: str) -> str:
    p = formatted(df)
    tree = p.split("\n\n")[0]
    pushed = sorted(set(re.findall(r"PushedFilters: (\[[^\n]*\])", p)))
    schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^\n]*>)", p)))
    counts = {k: len(re.findall(rf"\b{k}\b", tree)) for k in
              ("Exchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "Window", "HashAggregate",
               "SortAggregate")}
    lines = [f"## {name}", "", note, "", "```", tree.strip(), "```", "",
             "operators: " + ", ".join(f"{k} {v}" for k, v in counts.items() if v), ""]
    if pushed:
        lines += ["pushed filters: " + "; ".join(pushed), ""]
    if schemas:
        lines += ["read schemas: " + "; ".join(schemas), ""]
    return "\n".join(lines)


def main(sf: str) -> None:
    spark = local_session(4)
    root = scratch_dir(spark, "plans")
    path = lambda n: os.path.join(root, n)
    bars0 = load_bars(spark, sf)
    bars0.write.parquet(path("bars"))
    bars = spark.read.parquet(path("bars"))
    meta = load_ticker_metadata(spark, sf)
    indicators.silver_indicators(bars, "plain").write.parquet(path("silver"))
    dims.dim_date(bars).write.parquet(path("dd"))
    dims.dim_tickers_source(bars, meta).write.parquet(path("dt"))
    silver, dd, dt = (spark.read.parquet(path(n)) for n in ("silver", "dd", "dt"))
    facts.fact_daily(silver, dd, dt, strategy="plain").write.parquet(path("fact"))
    fact = spark.read.parquet(path("fact"))
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `python -m candela.checks.plans` over `{sf}` with stored inputs (as the pipeline"
           " stores them). Trees are Spark's formatted physical plans before adaptive re-planning.", ""]
    out.append(digest("bars fixture", bars0, "Line items joined to suppliers by the planner's size check, "
                      "one ordered aggregate with map-side partial aggregation."))
    out.append(digest("silver_ticker_indicators (plain)", indicators.silver_indicators(bars, "plain"),
                      "All twelve indicator groups: one exchange on ticker, one sort, two Window operators."))
    out.append(digest("silver_ticker_indicators (blocks)", indicators.silver_indicators(bars, "blocks"),
                      "Exact block split: rows numbered through a per-(ticker, year) calendar bitset that is "
                      "written once and broadcast by the planner, look-back copies, one exchange of the bars "
                      "on (ticker, block), two Window operators."))
    out.append(digest("fact_daily", facts.fact_daily(silver, dd, dt, strategy="plain"),
                      "Both dimensions broadcast; the 20-row volume window adds one exchange on ticker."))
    out.append(digest("fact_monthly", facts.fact_monthly(fact), "Hash/sort aggregate with partial aggregation."))
    out.append(digest("v_kpi_daily_market_health", views.v_kpi_daily_market_health(fact),
                      "One aggregate on date; only six fact columns are read."))
    out.append(digest("v_ticker_performance (as_of literal)",
                      views.v_ticker_performance(fact, dd, dt, as_of="2001-01-01"),
                      "The 30-day filter reaches the parquet scan of the fact."))
    blocked = frames.block_once(bars, indicators.silver_lookback() + facts.MEASURES_LOOKBACK + views.SCREEN_LOOKBACK)
    chain = facts.fact_daily(indicators.silver_indicators(blocked), dd, dt)
    out.append(digest("v_technical_screening (blocked chain from the bars)", views.v_technical_screening(chain, dt),
                      "Rows numbered and cut once for indicators, fact and screening: one exchange, one copying step, one sort."))
    out.append(digest("ind_ema", ema(bars),
                      "Block maps were composed in a first, narrow pass; here the rows are exchanged once by (ticker, block), the blocks' "
                      "entry states among them, and a walk over the sorted rows applies the maps."))
    out.append(digest("ind_macd_ema", macd_ema(bars), "Both legs and the signal: the same plan as for one average."))
    text = bars.withColumn("day", F.date_format("date", "yyyy-MM-dd"))
    out.append(digest("sma over a text order", indicators.run_indicators(text, ["sma"], order="day"),
                      "The rows were dealt by sampled ranges of (ticker, day), counted and stored; here a broadcast of one row per range "
                      "carries the counts on, and the rows are exchanged once by (ticker, block)."))
    print("\n".join(out))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
