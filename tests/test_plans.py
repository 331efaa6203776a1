"""Physical-plan checks: one exchange for all indicator windows, broadcast dimensions,
column pruning and filter pushdown into the parquet scans."""

import contextlib
import io
import os
import re

import pytest

from candela.operators import dims, facts, frames, indicators, views
from candela.sources.tpch_bars import load_bars, load_ticker_metadata
from tests.conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def header(p: str) -> str:
    """The tree part of a formatted plan (before the node details)."""
    return p.split("\n\n")[0]


@pytest.fixture(scope="module")
def stored(spark):
    import tempfile

    root = tempfile.mkdtemp(prefix="candela-plans-")
    bars = load_bars(spark, SF_SMALL)
    meta = load_ticker_metadata(spark, SF_SMALL)
    paths = {n: os.path.join(root, n) for n in ("bars", "silver", "dd", "dt", "fact")}
    bars.write.parquet(paths["bars"])
    bars = spark.read.parquet(paths["bars"])
    indicators.silver_indicators(bars, "plain").write.parquet(paths["silver"])
    dims.dim_date(bars).write.parquet(paths["dd"])
    dims.dim_tickers_source(bars, meta).write.parquet(paths["dt"])
    r = {k: spark.read.parquet(v) for k, v in paths.items() if k != "fact"}
    facts.fact_daily(r["silver"], r["dd"], r["dt"], strategy="plain").write.parquet(paths["fact"])
    r["fact"] = spark.read.parquet(paths["fact"])
    return r


def test_indicator_chain_one_exchange_two_windows(stored):
    p = header(plan(indicators.silver_indicators(stored["bars"], "plain")))
    assert len(re.findall(r"Exchange", p)) == 1
    assert len(re.findall(r"\bWindow \(", p)) == 2


def test_block_split_windows_on_ticker_and_block(stored):
    p = plan(indicators.silver_indicators(stored["bars"], "blocks"))
    assert re.search(r"hashpartitioning\(ticker#\d+, _blk#\d+", p)
    # the calendar is materialised beforehand; the bars are numbered through a broadcast
    # join, so they are shuffled once (on ticker, block) for the two indicator levels
    assert len(re.findall(r"\bWindow \(", header(p))) == 2
    assert len(re.findall(r"\bExchange\b", header(p))) == 1
    big = [m for m in re.findall(r"hashpartitioning\(([^)]*)\)", p) if "_blk" in m or "_yr" in m]
    assert len(big) == 1 and "_blk" in big[0]


def test_fact_daily_broadcasts_dims_and_reuses_partitioning(stored):
    p = header(plan(facts.fact_daily(stored["silver"], stored["dd"], stored["dt"], strategy="plain")))
    assert len(re.findall(r"BroadcastHashJoin", p)) == 2
    assert len(re.findall(r"Exchange", p)) == 1 + 2  # window exchange + two broadcast exchanges
    assert len(re.findall(r"BroadcastExchange", p)) == 2


def test_kpi_reads_only_needed_columns(stored):
    p = plan(views.v_kpi_daily_market_health(stored["fact"]))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    cols = {c.split(":")[0] for c in schema.split(",")}
    assert cols == {"date", "ticker", "dollar_volume", "daily_return_pct", "rsi", "is_high_volume"}


def test_date_filter_pushed_to_fact_scan(stored):
    v = views.v_ticker_performance(stored["fact"], stored["dd"], stored["dt"], as_of="1998-08-01")
    p = plan(v)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(date,", p)


def test_plain_chain_shuffles_bars_once(stored):
    s = indicators.silver_indicators(stored["bars"], "plain")
    f = facts.fact_daily(s, stored["dd"], stored["dt"], strategy="plain")
    v = views.v_technical_screening(f, stored["dt"], strategy="plain")
    p = header(plan(v))
    # silver, the fact's 20-row and the view's 30-row windows all reuse one exchange on ticker
    assert len(re.findall(r"\bExchange\b", p)) == 1
    assert len(re.findall(r"\bWindow \(", p)) <= 4


def test_blocked_chain_shuffles_bars_once(stored):
    bars = stored["bars"]
    blocked = frames.block_once(bars, indicators.silver_lookback() + facts.MEASURES_LOOKBACK + views.SCREEN_LOOKBACK)
    f = facts.fact_daily(indicators.silver_indicators(blocked), stored["dd"], stored["dt"])
    v = views.v_technical_screening(f, stored["dt"])
    p = header(plan(v))
    # numbered and cut once: one exchange and one copying step for indicators, fact and screening
    assert len(re.findall(r"\bExchange\b", p)) == 1
    assert len(re.findall(r"\bGenerate\b", p)) == 1
    assert len(re.findall(r"\bSort \(", p)) == 1
    plain = views.v_technical_screening(
        facts.fact_daily(indicators.silver_indicators(bars, "plain"), stored["dd"], stored["dt"], strategy="plain"),
        stored["dt"], strategy="plain",
    )
    assert v.columns == plain.columns and v.count() == plain.count()


def test_registered_chain_reads_line_items_once(spark):
    from candela.checks.queries import QUERIES

    for name in ("v_technical_screening", "fact_daily", "v_ticker_performance"):
        left = QUERIES[name](spark, SF_SMALL)  # the bars were written once while it was built
        assert not any("lineitem" in f for f in left.inputFiles()), name
