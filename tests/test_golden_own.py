"""Golden values over the repository's own two-ticker fixture: build_all against plain Python."""

import csv
import datetime as dt
import os
import tempfile

import pytest

from candela.plans.build import build_all
from candela.schema import TICKER_META_DDL

FIXTURE = os.path.join(os.path.dirname(__file__), "fixtures", "golden")
TICKERS = ("AA=F", "0005")


@pytest.fixture(scope="module")
def built(spark):
    root = tempfile.mkdtemp(prefix="candela-golden-own-")
    meta = spark.createDataFrame([], TICKER_META_DDL)
    return build_all(spark, FIXTURE, root, meta, year_floor=2022, as_of=dt.date(2024, 3, 20))


def bars(ticker):
    with open(os.path.join(FIXTURE, ticker, "bars.csv")) as f:
        return [{k.lower().replace(" ", "_"): v if k == "Date" else float(v) for k, v in r.items()} for r in csv.DictReader(f)]


def mean(x):
    return sum(x) / len(x)


def expected(rows):
    """Indicators of the last row, written from their definitions."""
    close = [r["close"] for r in rows]
    change = [b - a for a, b in zip(close, close[1:])]  # noqa: B905
    gain, loss = (mean([max(s * x, 0) for x in change[-14:]]) for s in (1, -1))
    tr = [max(r["high"] - r["low"], abs(r["high"] - p), abs(r["low"] - p)) for r, p in zip(rows[1:], close)]  # noqa: B905
    macd = [mean(close[max(0, k - 11) : k + 1]) - mean(close[max(0, k - 25) : k + 1]) for k in range(len(close))]
    m20 = mean(close[-20:])
    std = (sum((x - m20) ** 2 for x in close[-20:]) / 19) ** 0.5
    return {
        "sma_5": mean(close[-5:]), "sma_20": m20, "sma_50": mean(close[-50:]), "atr": mean(tr[-14:]),
        "rsi": 100 - 100 / (1 + gain / loss), "macd": macd[-1], "macd_signal": mean(macd[-9:]),
        "bbands_upper": m20 + 2 * std, "bbands_lower": m20 - 2 * std,
        "resistance": max(r["high"] for r in rows[-20:]), "support": min(r["low"] for r in rows[-20:]),
    }


@pytest.mark.parametrize("ticker", TICKERS)
def test_last_day_of_each_ticker(spark, built, ticker):
    rows = bars(ticker)
    fact = spark.read.parquet(built.paths["fact_daily_ticker_performance"])
    last = fact.where((fact["ticker"] == ticker) & (fact["date"] == rows[-1]["date"])).collect()
    assert len(last) == 1
    silver = spark.read.parquet(built.paths["silver_ticker_indicators"])
    assert silver.count() == 120
    for name, value in expected(rows).items():
        if name in last[0]:
            assert last[0][name] == pytest.approx(value, abs=1e-9), name


def test_tickers_keep_their_names(spark, built):
    dim = spark.read.parquet(built.paths["dim_tickers"])
    assert sorted(r["ticker"] for r in dim.collect()) == sorted(TICKERS)
    assert dict(dim.dtypes)["ticker"] == "string"
    assert built.silver_expectations["total"] == 120 and built.silver_expectations["rule1"] == 0


def test_views_by_date(spark, built):
    recent = spark.table("v_ticker_performance")
    assert {r["ticker"] for r in recent.collect()} == set(TICKERS)
    assert recent.agg({"date": "min"}).first()[0] >= dt.date(2024, 3, 20) - dt.timedelta(30)
