"""Run a registered Spark query and its DuckDB oracle side by side and compare the results.

Mirrors the driver's check: same column names, same row count, and an order-insensitive
comparison of the values (columns sorted by name, rows sorted).
"""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (int, float)):
        return round(float(v), 6)
    if hasattr(v, "isoformat"):
        s = str(v)
        return s[:10] if s[10:].strip("0: T") == "" else s
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> dict:
    sp = spark_df.toPandas()
    dk = con.execute(sql).fetchdf()
    res = {"spark_rows": len(sp), "oracle_rows": len(dk)}
    if sorted(c.lower() for c in sp.columns) != sorted(c.lower() for c in dk.columns):
        res["ok"] = False
        res["columns"] = (sorted(set(sp.columns) - set(dk.columns)), sorted(set(dk.columns) - set(sp.columns)))
        return res
    dk.columns = [next(s for s in sp.columns if s.lower() == c.lower()) for c in dk.columns]
    if len(sp) != len(dk):
        res["ok"] = False
        return res
    a, b = _rows(sp), _rows(dk)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    res["ok"] = not bad
    if bad:
        cols = sorted(sp.columns)
        per_col: dict[str, int] = {}
        for x, y in bad:
            for c, u, v in zip(cols, x, y):
                if u != v:
                    per_col[c] = per_col.get(c, 0) + 1
        res["mismatched_rows"] = len(bad)
        res["mismatched_columns"] = dict(sorted(per_col.items(), key=lambda kv: -kv[1])[:10])
        x, y = bad[0]
        res["first"] = {c: (u, v) for c, u, v in zip(cols, x, y) if u != v}
    return res
