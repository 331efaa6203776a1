"""The incremental pipeline equals the one-pass operators over the final bars, over corrections and crashes."""

import pytest
from pyspark.sql import functions as F

from candela.checks import oracle as O
from candela.checks.compare import duck, rows_of
from candela.checks.queries import norm
from candela.plans import incremental
from candela.sinks import parts
from candela.sources.csv_bars import write_bars_csv
from candela.sources.staging import stale_copies, write_malformed_csv
from candela.sources.tpch_bars import load_bars, load_ticker_metadata
from candela.streaming import summaries
from tests.conftest import SF_SMALL

SQL = {
    "silver": O.silver_sql, "fact_daily": O.fact_sql, "fact_weekly": O.weekly_sql, "fact_monthly": O.monthly_sql, "kpi_daily": O.v_kpi_sql,
    "dim_date": O.dim_date_sql, "dim_tickers": O.dim_tickers_sql,
}


def equals_sql(df, sql):
    cur = duck(SF_SMALL).execute(sql)
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    return rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cur.fetchall())


def test_all_tables_after_corrections_and_crashes(spark, tmp_root, monkeypatch):
    raw, root = f"{tmp_root}/raw", f"{tmp_root}/tables"
    bars, meta = load_bars(spark, SF_SMALL), load_ticker_metadata(spark, SF_SMALL)
    late = F.date_format("date", "yyyy-MM") == "1997-05"
    run = lambda: incremental.run_incremental(spark, raw, root, meta, buckets=2)
    first = bars.where(~late).unionByName(stale_copies(bars.where(late & (F.dayofmonth("date") < 25))).drop("processed_timestamp"))
    write_bars_csv(first, raw)
    run()
    write_bars_csv(bars.where(late), raw)
    plain = parts.replace_parts
    for name, module, what in (  # the run stops at a later step each time
        ("bars", parts, "replace_parts"), ("silver", parts, "replace_parts"), ("fact_monthly", summaries, "replace_groups"),
    ):

        def die(*a, name=name, plain=getattr(module, what), **kw):
            if any(isinstance(x, str) and x.rstrip("/") == f"{root}/{name}" for x in a):
                raise RuntimeError("Crash")
            return plain(*a, **kw)

        with monkeypatch.context() as m:
            m.setattr(module, what, die)
            with pytest.raises(Exception, match="Crash"):
                run()
    run()
    assert parts.replace_parts is plain
    for name, sql in SQL.items():
        assert equals_sql(norm(incremental.read(spark, root, name)), sql()), name
    assert incremental.read(spark, root, "bars").count() == bars.count()


def test_malformed_rows_are_held_back(spark, tmp_root):
    raw, root = f"{tmp_root}/raw", f"{tmp_root}/tables"
    bars = load_bars(spark, SF_SMALL).where("date < '1996-06-01'")
    write_malformed_csv(bars, raw)
    incremental.run_incremental(spark, raw, root, load_ticker_metadata(spark, SF_SMALL), buckets=2)
    bad = bars.where(F.dayofmonth("date").isin(4, 6, 8, 9, 10)).count()
    assert bad > 0 and incremental.read(spark, root, "quarantine").count() == bad
    assert incremental.read(spark, root, "fact_daily").count() == bars.count() - bad
