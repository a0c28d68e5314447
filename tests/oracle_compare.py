"""Run each registered query in Spark and its SQL oracle in DuckDB, and compare
row count, column names and the order-insensitive multiset of rows.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import collections
import math
import os
import sys
import time

import duckdb

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(HERE)
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        # exact: both engines must produce the same double, as the driver hashes values
        return "NaN" if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows]


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    out = {
        "name": name,
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "spark_s": round(t1 - t0, 2),
        "oracle_s": round(t2 - t1, 2),
        "cols_match": sorted(s_cols) == sorted(d_cols),
    }
    if out["cols_match"]:
        a = collections.Counter(_rows(s_cols, s_rows))
        b = collections.Counter(_rows(d_cols, d_rows))
        out["values_match"] = a == b
        if a != b:
            only_s = list((a - b).elements())[:3]
            only_d = list((b - a).elements())[:3]
            out["sample_spark_only"] = only_s
            out["sample_oracle_only"] = only_d
            out["cols"] = sorted(s_cols)
    else:
        out["values_match"] = False
        out["spark_cols"] = s_cols
        out["oracle_cols"] = d_cols
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from clientcurve.session import local_session

    spark = local_session(8, 8)
    qs = E.queries()
    sqls = E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            print(f"{name:28s} (no oracle)")
            continue
        try:
            r = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # report and continue
            bad += 1
            print(f"{name:28s} ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        ok = r["values_match"] and r["spark_rows"] == r["oracle_rows"]
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} rows={r['spark_rows']}/{r['oracle_rows']} "
              f"t={r['spark_s']}s/{r['oracle_s']}s" + ("" if ok else f" {r}"))
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
