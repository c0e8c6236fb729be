"""Run registered queries in Spark and their oracle SQL in DuckDB; compare results.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits: int | None):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if digits is None else float(f"{v:.{digits}g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item(), digits)
    return v


def rows_of(cols: list[str], rows, digits: int | None):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    res = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    if not res["cols_match"]:
        res["cols"] = (sorted(set(s_cols) - set(d_cols)), sorted(set(d_cols) - set(s_cols)))
        return res
    res["exact"] = rows_of(s_cols, s_rows, None) == rows_of(d_cols, d_rows, None)
    res["approx"] = res["exact"] or rows_of(s_cols, s_rows, 9) == rows_of(d_cols, d_rows, 9)
    if not res["approx"]:
        a, b = rows_of(s_cols, s_rows, 9), rows_of(d_cols, d_rows, 9)
        sa, sb = set(a), set(b)
        res["spark_only"] = [x for x in a if x not in sb][:3]
        res["oracle_only"] = [x for x in b if x not in sa][:3]
        res["sorted_cols"] = sorted(s_cols)
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from svcvitals.plans.oracle import ORACLE_SQL
    from svcvitals.plans.queries import QUERIES
    from svcvitals.session import build_session
    names = argv[2:] or list(QUERIES)
    spark = build_session("local[8]")
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, QUERIES[n], ORACLE_SQL[n], sf_dir)
        except Exception as e:  # report and continue
            r = {"name": n, "error": f"{type(e).__name__}: {str(e)[:600]}"}
        ok = r.get("exact") and r["spark_rows"] == r["oracle_rows"]
        bad += 0 if ok else 1
        print(("OK   " if ok else "DIFF ") + str(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} exact matches")


if __name__ == "__main__":
    main(sys.argv)
