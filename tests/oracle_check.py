"""Run registered queries in Spark and their oracle SQL in DuckDB and
compare row count, column names and order-insensitive values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ladle.sources.tables import BASE_TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE_TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    import numpy as np
    import pandas as pd
    if v is None or v is pd.NA or v is pd.NaT:
        return (0, "")
    if isinstance(v, np.ndarray):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return (2, repr([_norm(x) for x in v]))
    if isinstance(v, (bool, np.bool_)):
        return (3, str(bool(v)))
    if isinstance(v, (int, float, np.integer, np.floating)):
        f = float(v)
        if math.isnan(f):
            return (0, "")
        return (1, f"{round(f, 6):.6f}")
    if isinstance(v, pd.Timestamp):
        return (5, str(v.to_pydatetime().replace(tzinfo=None)))
    return (4, str(v))


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(_norm(x) for x in rec) for rec in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(out)


def compare(spark, sf_dir: str, names=None, verbose=True):
    from ladle.plans import oracle_sql, queries
    qs, orc = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            continue
        ts = time.time() - t0
        if name not in orc:
            results[name] = f"rows-only {len(sdf)} ({ts:.1f}s)"
            if verbose:
                print(f"{name:28s} {results[name]}", flush=True)
            continue
        try:
            odf = con.sql(orc[name]).df()
        except Exception as e:  # noqa: BLE001
            results[name] = f"ORACLE ERROR {type(e).__name__}: {str(e)[:300]}"
            continue
        sc, sr = rows_of(sdf)
        oc, orr = rows_of(odf)
        if sc != oc:
            results[name] = f"COLUMNS differ spark={sc} oracle={oc}"
        elif len(sr) != len(orr):
            results[name] = f"ROWCOUNT spark={len(sr)} oracle={len(orr)}"
        elif sr != orr:
            diff = [(a, b) for a, b in zip(sr, orr) if a != b][:2]
            results[name] = f"VALUES differ ({len(sr)} rows) e.g. {diff}"
        else:
            results[name] = f"ok {len(sr)} rows ({ts:.1f}s)"
        if verbose:
            print(f"{name:28s} {results[name]}", flush=True)
    return results


if __name__ == "__main__":
    from ladle.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if not (v.startswith("ok") or v.startswith("rows-only"))}
    print(f"\n{len(res) - len(bad)}/{len(res)} passed")
    for k, v in bad.items():
        print("FAIL", k, v)
