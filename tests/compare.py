"""Side-by-side check of queries() against oracle_sql() on DuckDB (dev tool)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (decimal.Decimal,)):
        v = float(v)
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, names=None, verbose=True):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in (names or qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            s_rows = [tuple(norm(x) for x in r) for r in sdf.collect()]
            s_cols = sdf.columns
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, results[name], flush=True)
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = f"no oracle ({len(s_rows)} rows)"
            print(name, results[name], flush=True)
            continue
        try:
            rel = con.execute(sqls[name])
            d_cols = [d[0] for d in rel.description]
            d_rows = [tuple(norm(x) for x in r) for r in rel.fetchall()]
        except Exception as e:  # noqa: BLE001
            results[name] = f"DUCK ERROR {str(e)[:300]}"
            print(name, results[name], flush=True)
            continue
        if sorted(s_cols) != sorted(d_cols):
            results[name] = f"COLUMNS {s_cols} vs {d_cols}"
            print(name, results[name], flush=True)
            continue
        idx = [d_cols.index(c) for c in s_cols]
        d_rows = [tuple(r[i] for i in idx) for r in d_rows]
        key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
        ss, dd = sorted(s_rows, key=key), sorted(d_rows, key=key)
        if ss == dd:
            results[name] = f"OK rows={len(ss)} {ts:.1f}s"
        else:
            diff = [(a, b) for a, b in zip(ss, dd) if a != b][:2]
            results[name] = f"MISMATCH rows {len(ss)} vs {len(dd)}; first diffs {diff}"
        print(name, results[name], flush=True)
    return results


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from tiffin.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2].split(",") if len(sys.argv) > 2 else None
    compare(spark, sf, names)
