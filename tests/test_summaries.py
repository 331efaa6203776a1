"""Partial states: merged in any cut they equal the one-pass summaries, and no batch counts twice."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from candela.operators import facts, partials, views
from candela.sinks import parts
from candela.streaming import summaries

SCHEMA = (
    "ticker_key long, ticker string, date date, open_price double, high_price double, low_price double, close_price double, volume long, "
    "dollar_volume double, daily_return_pct double, candle_color string, rsi double, sma_20 double, sma_50 double, is_high_volume boolean"
)
ONE_PASS = {
    "weekly": (partials.weekly, facts.fact_weekly), "iso": (lambda: partials.weekly("iso"), lambda f: facts.fact_weekly(f, "iso")),
    "monthly": (partials.monthly, facts.fact_monthly), "daily": (partials.daily_health, views.v_kpi_daily_market_health),
}


def daily_rows(seed, tickers=5, days=120):
    rng = random.Random(seed)
    start, out = dt.date(2024, 11, 1), []
    some = lambda x: None if rng.random() < 0.1 else x
    for t in [f"t{k}" for k in range(tickers)] + [None]:
        for d in range(days):
            if rng.random() < 0.2:
                continue
            o, c = rng.uniform(5, 9), rng.uniform(5, 9)
            ret = some((c - o) / o * 100 if rng.random() < 0.9 else 1e9)
            out.append((
                None if t is None else hash(t) % 1000, t, some(start + dt.timedelta(d)) if rng.random() < 0.1 else start + dt.timedelta(d), some(o),
                max(o, c) + 1, min(o, c) - 1, some(c), rng.randrange(0, 99), c * 7, ret,
                rng.choice(["Green", "Red", "Neutral"]), some(rng.uniform(0, 100)), some(o + 1), some(c + 1), some(rng.random() < 0.5),
            ))
    rng.shuffle(out)
    return out


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    names = sorted(a.columns)
    rounded = [F.round(c, 5).alias(c) if t == "double" else F.col(c).cast("string").alias(c) for c, t in sorted(a.dtypes)]
    rows = [sorted(map(str, df.select(rounded).select(names).collect())) for df in (a, b)]
    return rows[0] == rows[1]


@pytest.fixture
def root(tmp_root):
    return tmp_root


@pytest.mark.parametrize("kind", ONE_PASS)
def test_states_merge_to_the_one_pass_summary(spark, kind):
    summary, one_pass = ONE_PASS[kind][0](), ONE_PASS[kind][1]
    rows = [r for r in daily_rows(kind) if r[2] is not None]
    fact = spark.createDataFrame(rows, SCHEMA)
    states = partials.partial(spark.createDataFrame(rows[:1], SCHEMA), summary)  # a group of one row among them
    for at, end in ((1, 40), (40, 41), (41, 300), (300, len(rows))):
        states = partials.merge(states, partials.partial(spark.createDataFrame(rows[at:end], SCHEMA), summary), summary).checkpoint()
    assert same(summary.finish(states), one_pass(fact))
    assert same(summary.finish(partials.partial(fact, summary)), one_pass(fact))


def test_variance_does_not_cancel(spark):
    """Returns around 1e9 with a spread of 1: sums of squares would lose it."""
    rows = [(1, "a", dt.date(2024, 1, 1 + k % 28), 1.0, 1.0, 1.0, 1.0, 1, 1.0, 1e9 + k % 3, "Red", 1.0, 1.0, 1.0, True) for k in range(27)]
    s = partials.monthly()
    a, b = (partials.partial(spark.createDataFrame(part, SCHEMA), s) for part in (rows[:9], rows[9:]))
    got = s.finish(partials.merge(a, b, s)).first()["volatility"]
    assert got == pytest.approx((sum((k % 3 - 1) ** 2 for k in range(27)) / 26) ** 0.5, rel=1e-6)


def staged(spark, root, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")


def test_stored_summaries_over_batches_and_crashes(spark, root, monkeypatch):
    rows = daily_rows(3)
    tables = {f"{root}/w": partials.weekly(), f"{root}/m": partials.monthly(), f"{root}/d": partials.daily_health()}
    run = lambda: summaries.run_merge_summaries(spark, stream, tables, f"{root}/ck")
    stream = staged(spark, root, rows[:200])
    run()
    stream = staged(spark, root, rows[200:])
    plain = {name: getattr(parts, name) for name in ("replace_parts", "_note_done", "delete_path")}
    for name in plain:  # stop before the folders are replaced, before the batch is noted, and before the record goes
        def die(*a, name=name, **kw):
            target = next(x for x in a if isinstance(x, str))
            if target.startswith(f"{root}/m"):
                raise RuntimeError("Crash")
            return plain[name](*a, **kw)

        with monkeypatch.context() as m:
            m.setattr(parts, name, die)
            with pytest.raises(Exception, match="Crash"):
                run()
    run()
    run()
    fact = spark.createDataFrame(rows, SCHEMA)
    assert same(summaries.read_summary(spark, f"{root}/w", tables[f"{root}/w"]), facts.fact_weekly(fact))
    assert same(summaries.read_summary(spark, f"{root}/m", tables[f"{root}/m"]), facts.fact_monthly(fact))
    assert same(summaries.read_summary(spark, f"{root}/d", tables[f"{root}/d"]), views.v_kpi_daily_market_health(fact))


def test_groups_of_corrected_rows_are_computed_again(spark, root):
    rows = [r for r in daily_rows(4) if r[2] is not None and r[1] is not None]
    summary = partials.monthly()
    summaries.merge_batch(spark, spark.createDataFrame(rows, SCHEMA), f"{root}/m", summary, "s", 0)
    new = [(*r[:4], 99.0, *r[5:]) if r[2] == dt.date(2025, 1, 15) else r for r in rows]
    fact = spark.createDataFrame(new, SCHEMA)
    summaries.replace_groups(spark, fact, fact.where("date = '2025-01-15'"), f"{root}/m", summary, "fix")
    assert same(summaries.read_summary(spark, f"{root}/m", summary), facts.fact_monthly(fact))


def test_bitmaps_count_distinct_over_days_batches_and_many_ids(spark):
    rng = random.Random(5)
    rows = [(None if rng.random() < 0.01 else f"t{rng.randrange(70_000)}", dt.date(2024, 1 + rng.randrange(3), 1 + rng.randrange(28))) for _ in range(90_000)]
    df = spark.createDataFrame(rows, "ticker string, date date").repartition(4)
    first, rest = df.where("date < '2024-02-10'"), df.where("date >= '2024-02-10'")
    ids = partials.dense_ids(first).checkpoint()
    grown = partials.dense_ids(rest, ids).checkpoint()
    n = df.select("ticker").where("ticker is not null").distinct().count()
    assert n > 2 * 16_384 and sorted(r["id"] for r in grown.collect()) == list(range(n))
    assert grown.join(ids, ["ticker", "id"], "left_semi").count() == ids.count()
    daily = partials.ticker_bitmaps(first, grown, ["date"]).unionByName(partials.ticker_bitmaps(rest, grown, ["date"]))
    month = {"month": F.month("date")}
    got = partials.distinct_tickers(partials.merge_bitmaps(daily, month), ["month"])
    want = df.groupBy(F.month("date").alias("month")).agg(F.countDistinct("ticker").alias("unique_tickers"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert daily.select("bucket").distinct().count() == 3
