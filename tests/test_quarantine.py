"""Malformed raw rows and ticker lists of streams, on hand-made files."""

import datetime as dt
import os

import pytest

from candela.sources.csv_bars import read_bars_stream, read_checked_stream
from candela.streaming import jobs

HEADER = "Date,Open,High,Low,Close,Adj Close,Volume\n"
GOOD = "2025-06-02,1,2,0.5,1.5,1.5,100"


@pytest.fixture
def raw(tmp_root):
    def drop(ticker, name, *lines):
        os.makedirs(f"{tmp_root}/raw/{ticker}", exist_ok=True)
        with open(f"{tmp_root}/raw/{ticker}/{name}.csv", "w") as f:
            f.write(HEADER + "".join(line + "\n" for line in lines))
        return f"{tmp_root}/raw"

    return drop


BAD = {
    "2025-06-03,1,2,0.5": "short row: 4 fields",
    "2025-06-03,1,2,0.5,1.5,1.5,100,9": "long row: 8 fields",
    "2025-06-03,1,2,0.5,1.5,1.5,100,": "long row: 8 fields",
    "2025-06-03,1,2,0.5,oops,1.5,100": "not parsed: close",
    "2025-06-03,1,,x,oops,1.5,1.5": "not parsed: low, close, volume",
    "someday,1,2,0.5,1.5,1.5,100": "not parsed: date",
    "someday,1,2,0.5,1.5,z,100": "not parsed: date, adj_close",
    '"a,b",1,2,0.5,1.5,1.5,100': "not parsed: date",
    "x": "short row: 1 fields",
}


def test_every_kind_of_malformed_row(spark, raw, tmp_root):
    root = raw("AAPL", "one", GOOD, *BAD, "2025-06-04,1,2,0.5,,1.5,100", ",1,2,0.5,1.5,1.5,100")
    counts = jobs.run_ingest_with_quarantine(
        read_checked_stream(spark, root), f"{tmp_root}/good", f"{tmp_root}/bad", f"{tmp_root}/ck", [("priced", "close IS NOT NULL")]
    )
    assert counts == {"total": 3, "priced": 1, "malformed": len(BAD)}
    good = jobs.read_appended(spark, f"{tmp_root}/good")
    assert good.columns == ["ticker", "date", "open", "high", "low", "close", "adj_close", "volume"]
    assert sorted(map(tuple, good.collect()), key=str) == sorted(  # empty fields are NULLs, not malformed
        [("AAPL", dt.date(2025, 6, 2), 1.0, 2.0, 0.5, 1.5, 1.5, 100), ("AAPL", dt.date(2025, 6, 4), 1.0, 2.0, 0.5, None, 1.5, 100),
         ("AAPL", None, 1.0, 2.0, 0.5, 1.5, 1.5, 100)], key=str)
    bad = jobs.read_appended(spark, f"{tmp_root}/bad").collect()
    reasons = sorted((r["reason"] for r in bad))
    assert reasons == sorted(BAD.values()) and all(r["file"].endswith("/AAPL/one.csv") and r["ticker"] == "AAPL" for r in bad)
    texts = {r["text"]: r["reason"] for r in bad}
    assert {k: v for k, v in texts.items() if k in BAD} == {k: v for k, v in BAD.items() if k in texts} and len(set(texts) & set(BAD)) >= 7


def test_batches_that_run_again_replace_both_sinks(spark, raw, tmp_root):
    raw("A", "one", GOOD, "x")
    root = raw("B", "two", GOOD, "y", "z")
    run = lambda ck: jobs.run_ingest_with_quarantine(
        read_checked_stream(spark, root, max_files_per_trigger=1), f"{tmp_root}/good", f"{tmp_root}/bad", f"{tmp_root}/{ck}"
    )
    assert run("ck") == {"total": 2, "malformed": 3} and run("ck") == {"malformed": 0}
    raw("A", "later", "short,row", GOOD)
    assert run("ck") == {"total": 1, "malformed": 1}
    run("again")  # the same three batches once more, as after a crash before the stream's commit
    assert jobs.read_appended(spark, f"{tmp_root}/good").count() == 3
    assert sorted(r["text"] for r in jobs.read_appended(spark, f"{tmp_root}/bad").collect()) == ["short,row", "x", "y", "z"]


@pytest.mark.parametrize("read", [read_bars_stream, read_checked_stream])
def test_an_empty_ticker_list_leaves_all_files_to_later_runs(spark, raw, tmp_root, read):
    raw("A", "one", GOOD)
    root = raw("B", "two", GOOD)
    rows = []
    for tickers in ([], ["A"], [], None, []):
        jobs.run_append(read(spark, root, tickers=tickers), f"{tmp_root}/out", f"{tmp_root}/ck")
        stored = spark.read.schema("ticker string").parquet(f"{tmp_root}/out") if os.path.exists(f"{tmp_root}/out") else None
        rows.append(sorted(r["ticker"] for r in stored.collect()) if stored is not None else [])
    assert rows == [[], ["A"], ["A"], ["A", "B"], ["A", "B"]]
