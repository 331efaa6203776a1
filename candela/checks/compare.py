"""Run Spark queries and their DuckDB oracle side by side and diff the rows.

Usage: ``python -m candela.checks.compare [sf_dir] [name ...]``
"""

from __future__ import annotations

import math
import os
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _key(v):
    if v is None:
        return (0, "")
    if isinstance(v, float) and math.isnan(v):
        return (1, "nan")
    return (2, repr(v))


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_key(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, names=None, verbose=True):
    from candela.checks.registry import oracle_sql, queries

    qs, sql = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or qs:
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(name, results[name], flush=True)
            continue
        if name not in sql:
            results[name] = f"rows-only {len(srows)}"
            if verbose:
                print(name, results[name], flush=True)
            continue
        try:
            cur = con.execute(sql[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = f"SQL ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(name, results[name], flush=True)
            continue
        if sorted(scols) != sorted(dcols):
            results[name] = f"COLUMNS spark-only={sorted(set(scols) - set(dcols))} sql-only={sorted(set(dcols) - set(scols))}"
        else:
            a, b = rows_of(scols, srows), rows_of(dcols, drows)
            if a == b:
                results[name] = f"OK {len(a)} rows"
            else:
                sa, sb = set(a), set(b)
                diff_a = [r for r in a if r not in sb][:2]
                diff_b = [r for r in b if r not in sa][:2]
                results[name] = (f"MISMATCH spark={len(a)} sql={len(b)} only_spark={len(sa - sb)} only_sql={len(sb - sa)}"
                                 f"\n  cols={sorted(scols)}\n  s={diff_a}\n  d={diff_b}")
        if verbose:
            print(f"{name}: {results[name]} ({time.time() - t0:.1f}s)", flush=True)
    return results


if __name__ == "__main__":
    from candela.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    compare(spark, sf, sys.argv[2:] or None)
