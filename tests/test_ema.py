"""Recursive EMA: hierarchical block scan equals a plain sequential fold."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from candela.operators import ema as ema_module
from candela.operators import indicators
from candela.operators.ema import Leg, ema, ema_legs, macd_ema
from candela.sources.tpch_bars import load_bars
from tests.conftest import SF_SMALL


def brute(rows, span=12):
    a = 2.0 / (span + 1)
    out, last = {}, {}
    for t, d, c in sorted(rows, key=lambda r: (r[0], r[1])):
        if t not in last:
            e = c
        elif last[t] is None or c is None:
            e = None
        else:
            e = a * c + (1 - a) * last[t]
        last[t] = e
        out[(t, d)] = e
    return out


@pytest.mark.parametrize("block_rows", [4096, 50, 7])
def test_ema_matches_sequential_fold(spark, block_rows):
    bars = load_bars(spark, SF_SMALL).select("ticker", "date", "close")
    want = brute([tuple(r) for r in bars.collect()])
    got = {(r.ticker, r.date): r.ema_12 for r in ema(bars, block_rows=block_rows).collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[k] - want[k]) for k in want) < 1e-9


@pytest.mark.parametrize("block_rows", [4096, 3])
def test_ema_null_poisons_rest_of_series(spark, block_rows):
    rows = [("A", dt.date(2024, 1, d), float(d) if d != 5 else None) for d in range(1, 12)]
    rows.append(("B", dt.date(2024, 1, 1), 3.0))
    df = spark.createDataFrame(rows, "ticker STRING, date DATE, close DOUBLE")
    want = brute(rows)
    got = {(r.ticker, r.date): r.ema_12 for r in ema(df, block_rows=block_rows).collect()}
    for k, v in want.items():
        assert (got[k] is None) == (v is None), k
        if v is not None:
            assert got[k] == pytest.approx(v, abs=1e-12)


@pytest.mark.parametrize("block_rows", [4096, 3])
def test_ema_orders_null_date_first(spark, block_rows):
    rows = [("A", None, 10.0)] + [("A", dt.date(2024, 1, d), float(d)) for d in range(1, 9)]
    df = spark.createDataFrame(rows, "ticker STRING, date DATE, close DOUBLE")
    a = 2.0 / 13
    want, e = {}, None
    for _, d, c in [rows[0]] + rows[1:]:
        e = c if e is None else a * c + (1 - a) * e
        want[d] = e
    got = {r.date: r.ema_12 for r in ema(df, block_rows=block_rows).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-12), k


def fold(rows, legs):
    """Plain recurrences, row by row: rows (key, order, inputs by name) sorted; legs as in candela."""
    last, out = {}, {}
    for key, order, inputs in rows:
        now = {}
        for leg in legs:
            c = inputs[leg.col] if leg.of is None else sub(now[leg.of[0]], now[leg.of[1]])
            a = 2.0 / (leg.span + 1)
            old = last.get(key)
            if old is None:
                now[leg.out] = c
            else:
                now[leg.out] = None if c is None or old[leg.out] is None else a * c + (1 - a) * old[leg.out]
        last[key] = out[key, order] = now
    return out


def sub(a, b):
    return None if a is None or b is None else a - b


def same(a, b):
    if a is None or b is None:
        return a is b
    return a == b or (a != a and b != b) or abs(a - b) < 1e-9 * max(1, abs(b))


LEGS = [Leg("f", 3, "x"), Leg("s", 8, "x"), Leg("v", 5, "y"), Leg("g", 4, of=("f", "s")), Leg("h", 2, of=("g", "v"))]


@pytest.mark.parametrize(("block_rows", "fan", "slice_rows"), [(4096, 4096, 8192), (5, 3, 4), (7, 2, 3), (64, 4096, 10)])
def test_joint_scan_equals_plain_recurrences(spark, block_rows, fan, slice_rows):
    rng = random.Random(block_rows)
    odd = {("B", 20): None, ("C", 9): math.nan, ("D", 12): math.inf, ("E", 3): math.inf, ("E", 30): -math.inf, ("F", 1): -math.inf}
    rows = []
    for key, n in [("A", 150), ("B", 60), ("C", 40), ("D", 50), ("E", 40), ("F", 20), (None, 33), ("G", 1), *[(f"k{i}", 3) for i in range(30)]]:
        at = 0
        for i in range(n):
            at += rng.choice([1, 1, 1, 4])
            x = odd.get((key, i), rng.uniform(1, 9))
            rows.append((key, dt.date(2020, 1, 1) + dt.timedelta(days=at), {"x": x, "y": None if rng.random() < 0.01 else rng.uniform(-5, 5)}))
    want = fold(rows, LEGS)
    df = spark.createDataFrame([(k, d, v["x"], v["y"], "kept") for k, d, v in rows], "ticker string, date date, x double, y double, note string")
    got = ema_legs(df.repartition(5), LEGS, block_rows=block_rows, fan=fan, slice_rows=slice_rows)
    assert got.columns == [*df.columns, "f", "s", "v", "g", "h"]
    found = got.collect()
    assert len(found) == len(rows) and {r["note"] for r in found} == {"kept"}
    for r in found:
        for leg in LEGS:
            assert same(r[leg.out], want[r["ticker"], r["date"]][leg.out]), (r, leg, want[r["ticker"], r["date"]])


@pytest.mark.parametrize("order_type", ["int", "string", "timestamp"])
def test_joint_scan_in_other_orders(spark, order_type):
    rows = [("A" if i % 3 else "B", i, {"x": float(i * i % 17)}) for i in range(100)]
    legs = LEGS[:2] + LEGS[3:4]
    want = fold(rows, legs)
    order = {"int": F.col("n"), "string": F.format_string("%05d", "n"), "timestamp": F.timestamp_seconds("n")}[order_type]
    df = spark.createDataFrame([(k, n, v["x"]) for k, n, v in rows], "ticker string, n int, x double").withColumn("o", order)
    for r in ema_legs(df.repartition(3), legs, order="o", block_rows=8, fan=4).collect():
        assert all(same(r[leg.out], want[r["ticker"], r["n"]][leg.out]) for leg in legs)


def test_empty_input(spark):
    df = spark.createDataFrame([], "ticker string, date date, close double")
    assert ema(df).count() == 0 and ema(df).columns == ["ticker", "date", "close", "ema_12"]


def test_input_is_read_twice_and_rows_move_once(spark, tmp_root):
    """One narrow pass for the block maps, one exchange of the rows, however many averages there are."""
    path = f"{tmp_root}/bars"
    load_bars(spark, SF_SMALL).write.parquet(path)
    bars = spark.read.parquet(path)
    plan = macd_ema(bars)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") - plan.count("ema-blocks") == 1
    assert plan.count("hashpartitioning(ticker") == 2  # the rows with their markers; the small list of block maps
    legs = [Leg(f"e{i}", 5 + i, "close") for i in range(6)]
    assert ema_legs(bars, legs)._jdf.queryExecution().executedPlan().toString().count("Exchange") == plan.count("Exchange")


def test_chain_joins_its_averages_in_one_scan(spark, monkeypatch):
    calls = []
    plain = indicators.ema_legs
    monkeypatch.setattr(indicators, "ema_legs", lambda df, legs, **kw: (calls.append([x.out for x in legs]), plain(df, legs, **kw))[1])
    bars = load_bars(spark, SF_SMALL)
    chain = indicators.IndicatorChain(bars, "ticker", "date").ema(kind="recursive").macd(kind="ema").ema("close", 50, "ema_50", kind="recursive")
    out = chain.ema("ema_50", 5, "ema_of_ema", kind="recursive").get_df()
    assert calls == [["ema_12", "ema_fast", "ema_slow", "macd_signal", "ema_50"], ["ema_of_ema"]]
    one = {(r["ticker"], r["date"]): r for r in ema(ema(bars, span=50, out_col="ema_50"), "ema_50", 5, "x").collect()}
    lines = {(r["ticker"], r["date"]): r for r in macd_ema(bars).collect()}
    for r in out.collect():
        at = r["ticker"], r["date"]
        assert same(r["ema_of_ema"], one[at]["x"]) and all(same(r[c], lines[at][c]) for c in ("macd", "macd_signal", "macd_gap"))
        assert same(r["ema_12"], r["ema_fast"])


def test_wrong_legs_are_refused():
    for bad in ([Leg("a", 3, "x"), Leg("a", 4, "x")], [Leg("g", 3, of=("a", "b")), Leg("a", 3, "x"), Leg("b", 3, "x")]):
        with pytest.raises(ValueError):
            ema_module.System(bad)
