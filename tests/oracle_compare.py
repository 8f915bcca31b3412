"""Compare a registered Spark query with its DuckDB oracle SQL.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Columns are compared by name, rows order-insensitively; doubles within
1e-6 relative (both sides are already rounded to 4 places).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

def duck(sf_dir: str):
    con = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        t = file.removesuffix(".parquet")
        part = "/*.parquet" if os.path.isdir(f"{sf_dir}/{file}") else ""
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{file}{part}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 4)
    if hasattr(v, "as_integer_ratio") and not isinstance(v, int):
        return round(float(v), 4)
    if isinstance(v, (dt.datetime,)):
        return v.date().isoformat() if v.time() == dt.time(0) else v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0)
                 for x in row)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]

    def key(r):  # exact columns first, floats last (rounding may differ by one unit)
        exact = tuple(repr(x) for x in r if not isinstance(x, float))
        approx = tuple(x for x in r if isinstance(x, float))
        return exact, approx

    return [cols[i] for i in order], sorted(out, key=key)


def close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return abs(a - b) <= 1e-6 * max(1.0, abs(a), abs(b)) + 1.5e-4
    if isinstance(a, (int, float)) and isinstance(b, (int, float)) and not isinstance(a, bool):
        return abs(a - b) <= 1.5e-4
    return a == b


def compare(spark, name: str, sf_dir: str, con=None, verbose=True):
    from __spark_entry__ import oracle_sql, queries

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = queries()[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    sql = oracle_sql().get(name)
    if sql is None:
        return {"name": name, "ok": None, "rows": len(s_rows), "spark_s": round(t1 - t0, 2)}
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sr = rows_of(s_cols, s_rows)
    dc, dr = rows_of(d_cols, d_rows)
    msg = ""
    ok = True
    if sc != dc:
        ok, msg = False, f"columns differ: spark-only {set(sc) - set(dc)} duck-only {set(dc) - set(sc)}"
    elif len(sr) != len(dr):
        ok, msg = False, f"row count {len(sr)} vs {len(dr)}"
    else:
        for a, b in zip(sr, dr):
            if not all(close(x, y) for x, y in zip(a, b)):
                ok, msg = False, f"first diff:\n  spark {a}\n  duck  {b}"
                break
    if verbose and not ok:
        print(name, msg)
    return {"name": name, "ok": ok, "rows": len(s_rows), "msg": msg, "spark_s": round(t1 - t0, 2)}


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from panelcast.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark("local[8]", shuffle_partitions=8)
    from __spark_entry__ import queries

    for n in names or list(queries()):
        try:
            r = compare(spark, n, sf, duck(sf))  # fresh connection per query
        except Exception as e:  # report and continue
            r = {"name": n, "ok": False, "msg": f"{type(e).__name__}: {str(e)[:600]}"}
        print(r["name"], r.get("ok"), r.get("rows"), r.get("spark_s"), r.get("msg", "")[:2000], flush=True)
