"""Run a registered query on Spark and its oracle on DuckDB; compare results.

Comparison: same row count, same column names, same multiset of rows after a
canonical text form of each value (floats at 6 places, timestamps ISO).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{round(v, 6):.6f}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, decimal.Decimal)):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    return str(v)


def compare(spark, name: str, fn, sql: str | None, sf_dir: str, con=None) -> dict:
    sdf = fn(spark, sf_dir)
    s_cols = list(sdf.columns)
    s_rows = [tuple(canon(r[c]) for c in sorted(s_cols)) for r in sdf.collect()]
    res = {"name": name, "spark_rows": len(s_rows), "columns": sorted(s_cols)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    rel = con.execute(sql)
    o_cols = [d[0] for d in rel.description]
    o_raw = rel.fetchall()
    idx = {c: i for i, c in enumerate(o_cols)}
    res["oracle_rows"] = len(o_raw)
    if sorted(o_cols) != sorted(s_cols):
        res["status"] = f"columns differ: spark={sorted(s_cols)} oracle={sorted(o_cols)}"
        return res
    o_rows = [tuple(canon(r[idx[c]]) for c in sorted(s_cols)) for r in o_raw]
    if len(o_rows) != len(s_rows):
        res["status"] = "row count differs"
    elif sorted(o_rows) != sorted(s_rows):
        a, b = set(s_rows), set(o_rows)
        res["status"] = "values differ"
        res["spark_only"] = sorted(a - b)[:3]
        res["oracle_only"] = sorted(b - a)[:3]
    else:
        res["status"] = "match"
    return res
