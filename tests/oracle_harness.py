"""Local twin of the driver's check: run a registered query on Spark and its oracle SQL on DuckDB, compare.

Comparison: row count, column names, then the multiset of rows with doubles to six decimals or ten significant digits.
"""

from __future__ import annotations

import datetime
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = float(f"{v:.9e}") if abs(v) >= 1e4 else round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return float(v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    try:
        import numpy as np
        if isinstance(v, np.ndarray):
            return tuple(_norm(x) for x in v.tolist())
    except Exception:
        pass
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, repr(x)) for x in row)


def compare(spark, name, fn, sql, sf_dir, con=None):
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    t2 = time.time()
    msg = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows), "spark_s": round(t1 - t0, 2),
           "duck_s": round(t2 - t1, 2)}
    if sorted(s_cols) != sorted(d_cols):
        msg["error"] = f"columns differ: spark={s_cols} duck={d_cols}"
        return False, msg
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in d_rows), key=_key)
    if a != b:
        diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
        msg["error"] = f"values differ, first diffs: {diffs}"
        return False, msg
    return True, msg


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from flowprism.session import build_session
    import __spark_entry__ as E

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session()
    qs, os_ = E.queries(), E.oracle_sql()
    con = duck(sf)
    bad = 0
    for n in (names or list(qs)):
        if n not in os_:
            t0 = time.time()
            c = qs[n](spark, sf).count()
            print(f"ROWS  {n}: {c} rows ({time.time() - t0:.1f}s, no oracle)", flush=True)
            continue
        try:
            ok, m = compare(spark, n, qs[n], os_[n], sf, con)
        except Exception as e:  # report and continue
            ok, m = False, {"name": n, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += not ok
        print(("OK    " if ok else "FAIL  ") + str(m), flush=True)
    print(f"failures: {bad}")
