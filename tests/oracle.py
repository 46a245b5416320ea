"""Compare a Spark query with its DuckDB SQL the way the driver does: row count, column names and
an order-insensitive hash of the values (columns sorted by name, doubles rounded)."""

from __future__ import annotations

import hashlib
import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_hash(cols: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    normed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256()
    for r in normed:
        h.update(r.encode())
    return h.hexdigest()


def compare(spark, sf_dir: str, fn, sql: str, con=None) -> dict:
    con = con or duck(sf_dir)
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {
        "rows": (len(s_rows), len(d_rows)),
        "cols_match": sorted(s_cols) == sorted(d_cols),
        "hash_match": rows_hash(s_cols, s_rows) == rows_hash(d_cols, d_rows),
        "spark_cols": s_cols,
        "duck_cols": d_cols,
    }
    if not out["hash_match"]:
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        ss = sorted(repr(tuple(_norm(r[i]) for i in order_s)) for r in s_rows)
        dd = sorted(repr(tuple(_norm(r[i]) for i in order_d)) for r in d_rows)
        only_s = sorted(set(ss) - set(dd))[:3]
        only_d = sorted(set(dd) - set(ss))[:3]
        out["only_spark"] = only_s
        out["only_duck"] = only_d
    return out
