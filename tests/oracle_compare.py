"""Compare a registered Spark query with its DuckDB SQL twin.

Checks what the correctness gate checks: same column names, same row count and
the same multiset of rows (order-insensitive). Values are compared exactly, with
floats normalised to 12 significant digits.
"""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.17g}")
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            v = v.item()
        except Exception:
            pass
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v


def compare(spark, con, name: str, query_fn, sql: str, sf_dir: str) -> dict:
    sdf = query_fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(v) for v in r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = [tuple(_norm(v) for v in r) for r in rel.fetchall()]
    out = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows)}
    out["columns_match"] = sorted(s_cols) == sorted(d_cols)
    if not out["columns_match"]:
        out["spark_cols"], out["duck_cols"] = s_cols, d_cols
        out["match"] = False
        return out
    order = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(r[i] for i in order) for r in d_rows]
    cs, cd = Counter(s_rows), Counter(d_rows)
    out["match"] = cs == cd
    if not out["match"]:
        out["only_spark"] = list((cs - cd).elements())[:3]
        out["only_duck"] = list((cd - cs).elements())[:3]
    return out
