"""Run a registered query in Spark and its oracle SQL in DuckDB and compare
(row count, column names, values).  Used by tests and from the command line:

    python tests/oracle_harness.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, str(x)) for x in row)


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame, tol: float = 1e-9):
    cols_s = sorted(spark_pdf.columns)
    cols_d = sorted(duck_pdf.columns)
    if cols_s != cols_d:
        return False, f"columns differ: {cols_s} vs {cols_d}"
    if len(spark_pdf) != len(duck_pdf):
        return False, f"row count {len(spark_pdf)} vs {len(duck_pdf)}"
    a = sorted((tuple(_norm(v) for v in r) for r in spark_pdf[cols_s].itertuples(index=False)), key=_key)
    b = sorted((tuple(_norm(v) for v in r) for r in duck_pdf[cols_s].itertuples(index=False)), key=_key)
    bad = 0
    first = None
    for ra, rb in zip(a, b):
        for c, x, y in zip(cols_s, ra, rb):
            same = x == y
            if not same and isinstance(x, float) and isinstance(y, float):
                same = abs(x - y) <= tol * max(1.0, abs(x), abs(y))
            if not same and isinstance(x, (int, float)) and isinstance(y, (int, float)) and not isinstance(x, bool):
                same = abs(float(x) - float(y)) <= tol * max(1.0, abs(float(x)))
            if not same:
                bad += 1
                if first is None:
                    first = (c, x, y, ra[:3])
    if bad:
        return False, f"{bad} value mismatches, first {first}"
    return True, "ok"


def run(sf_dir: str, names=None):
    from __spark_entry__ import oracle_sql, queries
    from fleetlens.session import local_session

    spark = local_session(8)
    qs = queries()
    sql = oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            results[name] = (False, f"spark error: {str(e)[:300]}")
            print(name, results[name], flush=True)
            continue
        ts = time.time() - t0
        if name not in sql:
            results[name] = (True, f"rows-only: {len(sdf)} rows")
            print(name, results[name], f"{ts:.1f}s", flush=True)
            continue
        try:
            dpdf = con.execute(sql[name]).df()
        except Exception as e:  # noqa: BLE001
            results[name] = (False, f"duckdb error: {str(e)[:300]}")
            print(name, results[name], flush=True)
            continue
        results[name] = compare(sdf, dpdf)
        print(name, results[name], f"rows={len(sdf)} {ts:.1f}s", flush=True)
    return results


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    res = run(sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if not v[0]]
    print("FAILED:", bad)
