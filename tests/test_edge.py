"""Edge fixture (FIXTURES section 5): hand-written rows through the operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candela.operators import dims, facts, indicators, quality, views
from candela.operators.dedup import dedup_bars
from candela.operators.frames import STRATEGIES
from candela.schema import TICKER_META_DDL

D = dt.date
BAR_DDL = "ticker STRING, date DATE, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, adj_close DOUBLE, volume BIGINT"

EDGE_ROWS = [
    ("ONE", D(2024, 3, 1), 10.0, 11.0, 9.0, 10.5, 10.5, 100),       # single-row ticker
    ("FLAT", D(2024, 12, 30), 5.0, 5.0, 5.0, 5.0, 5.0, 0),         # flat bar, zero volume, ISO week 1 of 2025
    ("FLAT", D(2024, 1, 2), 5.0, 5.0, 5.0, 5.0, 5.0, 10),          # week 1 of 2024
    ("FLAT", D(2024, 8, 30), 5.0, 6.0, 4.0, 5.5, 5.5, 10),         # Friday before a weekend month end
    ("NUL", D(2024, 3, 1), 1.0, 2.0, 0.5, None, None, 5),          # NULL close
    ("NUL", D(2024, 3, 4), 1.0, 2.0, 0.5, 1.5, 1.5, 5),
]


@pytest.fixture()
def edge(spark):
    return spark.createDataFrame(EDGE_ROWS, BAR_DDL)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_single_row_and_flat_bars(spark, edge, strategy):
    s = indicators.silver_indicators(edge, strategy).orderBy("ticker", "date").collect()
    one = [r for r in s if r.ticker == "ONE"][0]
    assert one.sma_50 == 10.5 and one.ema_12 == 10.5 and one.bbands_upper is None
    assert one.tr == 2.0 and one.atr == 2.0 and one.rsi is None and one.obv == 0
    flat = [r for r in s if r.ticker == "FLAT"]
    first = flat[0]  # 2024-01-02
    assert first.adl is None  # h == l: the only term is NULL
    assert first.stoch_oscillator is None and first.cci is None


def test_rules_count_null_as_failure(spark, edge):
    v = {r.rule: r.failed_records for r in quality.violation_counts(edge, quality.silver_rules(2022)).collect()}
    assert v == {"rule1": 0, "rule2": 0, "rule3": 1, "rule4": 0, "rule5": 1}
    kept = quality.expect_all(edge, quality.silver_rules(2022), mode="drop")
    assert kept.count() == len(EDGE_ROWS) - 2
    with pytest.raises(Exception):
        quality.expect_all(edge, quality.silver_rules(2022), mode="fail").collect()


def test_unparseable_date_lands_as_null(spark, tmp_root):
    import os

    from candela.sources.csv_bars import read_bars_csv

    os.makedirs(os.path.join(tmp_root, "XYZ"))
    with open(os.path.join(tmp_root, "XYZ", "x.csv"), "w") as f:
        f.write("Date,Open,High,Low,Close,Adj Close,Volume\nnot-a-date,1,2,0.5,1.5,1.5,10\n2024-01-03,1,2,0.5,1.5,1.5,10\n")
    b = read_bars_csv(spark, tmp_root).orderBy("date").collect()
    assert [r.ticker for r in b] == ["XYZ", "XYZ"]
    assert sorted([r.date is None for r in b]) == [False, True]


def test_dedup_keeps_latest_copy(spark, edge):
    ts = lambda h: dt.datetime(2025, 1, 1, h)
    old = edge.withColumn("processed_timestamp", F.lit(ts(1))).withColumn("close", F.lit(-1.0))
    new = edge.withColumn("processed_timestamp", F.lit(ts(2)))
    out = dedup_bars(old.unionByName(new)).orderBy("ticker", "date").collect()
    assert len(out) == len(EDGE_ROWS)
    assert all(r.close != -1.0 for r in out)


def test_weekly_year_modes(spark, edge):
    meta = spark.createDataFrame([], TICKER_META_DDL)
    s = indicators.silver_indicators(edge)
    f = facts.fact_daily(s, dims.dim_date(edge), dims.dim_tickers_source(edge, meta))
    cal = facts.fact_weekly(f).where("ticker = 'FLAT' AND week_of_year = 1").collect()
    assert len(cal) == 1 and cal[0].year == 2024 and cal[0].trading_day == 2
    iso = facts.fact_weekly(f, year_mode="iso").where("ticker = 'FLAT' AND week_of_year = 1").collect()
    assert sorted(r.year for r in iso) == [2024, 2025]


def test_month_end_is_calendar(spark, edge):
    d = {r.date: r for r in dims.dim_date(edge).collect()}
    assert d[D(2024, 8, 30)].is_month_end is False
    assert d[D(2024, 12, 30)].is_quarter_end is False
    assert d[D(2024, 12, 30)].week_of_year == 1 and d[D(2024, 12, 30)].date_key == 20241230


def test_missing_metadata_gets_defaults(spark, edge):
    meta = spark.createDataFrame([("ONE", "One Inc", "Tech", "Chips", 250_000_000_000, None, "US", "USD", "NMS")],
                                 TICKER_META_DDL)
    t = {r.ticker: r for r in dims.dim_tickers_source(edge, meta).collect()}
    assert t["ONE"].market_cap_category == "Mega Cap" and t["ONE"].sector == "Tech"
    assert t["NUL"].sector == "Unknown" and t["NUL"].currency == "USD" and t["NUL"].market_cap_category == "Unknown"


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_all_gain_day_sentiment(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        fact = spark.createDataFrame(
            [("A", D(2024, 1, 2), 1.0, 50.0, 10.0, True), ("B", D(2024, 1, 2), 2.0, 60.0, 20.0, False)],
            "ticker STRING, date DATE, daily_return_pct DOUBLE, rsi DOUBLE, dollar_volume DOUBLE, is_high_volume BOOLEAN",
        )
        strict = views.v_kpi_daily_market_health(fact).first()
        assert strict.losers == 0 and strict.advance_decline_ratio is None
        assert strict.market_sentiment == "Very bearish"
        assert views.v_kpi_daily_market_health(fact, strict=False).first().market_sentiment == "Very bullish"
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_scd1_late_older_version_ignored(spark):
    ddl = "k STRING, v STRING, seq TIMESTAMP"
    cur = spark.createDataFrame([("a", "new", dt.datetime(2025, 1, 2)), ("b", "keep", dt.datetime(2025, 1, 1))], ddl)
    late = spark.createDataFrame([("a", "old", dt.datetime(2025, 1, 1)), ("c", "add", dt.datetime(2024, 1, 1))], ddl)
    out = {r.k: r.v for r in dims.scd1_latest(late, ["k"], ["seq"], target=cur).collect()}
    assert out == {"a": "new", "b": "keep", "c": "add"}


def test_ticker_list_narrows_the_glob(spark, tmp_root):
    import os

    from candela.sources.csv_bars import _glob, read_bars_csv

    for t in ("AAA", "BBB", "CCC"):
        os.makedirs(os.path.join(tmp_root, t))
        with open(os.path.join(tmp_root, t, "x.csv"), "w") as f:
            f.write("Date,Open,High,Low,Close,Adj Close,Volume\n2024-01-03,1,2,0.5,1.5,1.5,10\n")
    assert _glob(tmp_root, ["AAA", "CCC"]).endswith("/{AAA,CCC,ticker=AAA,ticker=CCC}/")
    got = sorted(r.ticker for r in read_bars_csv(spark, tmp_root, ["AAA", "CCC"]).collect())
    assert got == ["AAA", "CCC"]


def test_no_ticker_folder_gives_empty_typed_frame(spark, tmp_root):
    from candela.sources.csv_bars import read_bars_csv

    df = read_bars_csv(spark, tmp_root)
    assert df.count() == 0
    assert df.columns == ["ticker", "date", "open", "high", "low", "close", "adj_close", "volume"]
    assert dict(df.dtypes)["date"] == "date"


def test_metadata_from_csv_file(spark, tmp_root, edge):
    import os

    from candela.sources.metadata import read_ticker_metadata

    path = os.path.join(tmp_root, "meta.csv")
    with open(path, "w") as f:
        f.write("ticker,company_name,sector,industry,market_cap,market_cap_category,country,currency,exchange\n")
        f.write("ONE,One Inc,Tech,Chips,5000000000,,US,USD,NMS\n")
    meta = read_ticker_metadata(spark, path)
    t = {r.ticker: r for r in dims.dim_tickers_source(edge, meta).collect()}
    assert t["ONE"].market_cap == 5_000_000_000 and t["ONE"].market_cap_category == "Mid Cap"
    assert t["FLAT"].company_name == "Unknown"


def test_blocks_keep_null_date_and_null_ticker_rows(spark, edge):
    extra = spark.createDataFrame(
        [("NUL", None, 1.0, 2.0, 0.5, 1.2, 1.2, 5), (None, D(2024, 3, 1), 3.0, 4.0, 2.0, 3.5, 3.5, 7)], BAR_DDL)
    bars = edge.unionByName(extra)
    plain = indicators.silver_indicators(bars, "plain")
    blk = indicators.silver_indicators(bars, "blocks", block_rows=65)
    num = [c for c, t in plain.dtypes if t in ("double", "bigint")]
    a = plain.select("ticker", "date", *[F.round(c, 8).alias(c) for c in num])
    b = blk.select("ticker", "date", *[F.round(c, 8).alias(c) for c in num])
    assert blk.count() == bars.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
