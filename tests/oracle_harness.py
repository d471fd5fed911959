"""Run a registered query in Spark and its SQL oracle in DuckDB; compare.

Usage: python -m tests.oracle_harness [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        if not os.path.exists(f"{sf_dir}/{t}.parquet"):
            continue
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, sf_dir, name, fn, sql):
    t = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    ts = time.time() - t
    if sql is None:
        return {"name": name, "ok": None, "rows": len(s_rows), "spark_s": round(ts, 2)}
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    info = {"name": name, "rows": len(s_rows), "oracle_rows": len(d_rows), "spark_s": round(ts, 2)}
    if sorted(s_cols) != sorted(d_cols):
        info.update(ok=False, why=f"columns differ: {sorted(set(s_cols) ^ set(d_cols))}")
        return info
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        info.update(ok=False, why=f"values differ (first): {diff}")
        return info
    info["ok"] = True
    return info


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from mesura.session import get_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = get_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        try:
            info = compare(spark, con, sf_dir, name, qs[name], sqls.get(name))
        except Exception as e:  # report and go on
            info = {"name": name, "ok": False, "why": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += info.get("ok") is False
        print(info, flush=True)
    print(f"FAILED {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
