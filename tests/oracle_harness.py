"""Run registered queries in Spark and their SQL in DuckDB; compare results.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
Comparison: same column names (sorted), same row count, same multiset of
rows (values compared exactly after sorting rows; floats also reported
with their largest absolute difference when they do not match).
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, v)
    if isinstance(v, (list, tuple)):
        return (2, tuple(_norm(x) for x in v))
    if hasattr(v, "item"):
        try:
            return _norm(v.item())
        except Exception:  # noqa: BLE001
            pass
    if isinstance(v, bool):
        return (1, int(v))
    if isinstance(v, int):
        return (1, v)
    if isinstance(v, dict):
        return (3, tuple(sorted((k, _norm(x)) for k, x in v.items())))
    return (4, str(v))


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    msgs = []
    if sorted(spark_cols) != sorted(duck_cols):
        return False, [f"columns differ: spark={sorted(spark_cols)} duck={sorted(duck_cols)}"]
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    a = sorted(tuple(_norm(r[i]) for i in si) for r in spark_rows)
    b = sorted(tuple(_norm(r[i]) for i in di) for r in duck_rows)
    if len(a) != len(b):
        return False, [f"row count spark={len(a)} duck={len(b)}"]
    bad = 0
    maxdiff = {}
    for ra, rb in zip(a, b):
        if ra != rb:
            bad += 1
            for c, x, y in zip(order, ra, rb):
                if x != y:
                    if isinstance(x[1], float) and isinstance(y[1], (int, float)):
                        maxdiff[c] = max(maxdiff.get(c, 0), abs(x[1] - y[1]))
                    else:
                        maxdiff.setdefault(c, f"{x!r} vs {y!r}")
    if bad:
        msgs.append(f"{bad} rows differ; by column: {maxdiff}")
    return bad == 0, msgs


def run(names=None, sf_dir="/root/testdata/sf0.01", spark=None, verbose=True):
    import __spark_entry__ as e
    from pricewise.session import get_session
    spark = spark or get_session("local[8]")
    qs, sql = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as ex:  # noqa: BLE001
            results[name] = (False, [f"spark failed: {str(ex)[:800]}"])
            print(name, "SPARK FAIL", str(ex)[:800]) if verbose else None
            continue
        ts = time.time() - t0
        if name not in sql:
            results[name] = (True, [f"rows-only: {len(rows)} rows"])
            if verbose:
                print(f"{name:28s} rows-only {len(rows)} rows  {ts:.1f}s")
            continue
        try:
            cur = con.execute(sql[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as ex:  # noqa: BLE001
            results[name] = (False, [f"duckdb failed: {str(ex)[:800]}"])
            print(name, "DUCK FAIL", str(ex)[:800]) if verbose else None
            continue
        ok, msgs = compare(rows, cols, drows, dcols)
        results[name] = (ok, msgs)
        if verbose:
            print(f"{name:28s} {'OK ' if ok else 'BAD'} {len(rows)} rows  {ts:.1f}s  {' '.join(msgs)}")
    return results


if __name__ == "__main__":
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    res = run(args or None, sf)
    bad = [k for k, (ok, _) in res.items() if not ok]
    print("FAILED:", bad if bad else "none")
