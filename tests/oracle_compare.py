"""Compare a Spark query with its DuckDB oracle: row count, column names and
an order-insensitive comparison of normalised values."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__), str(x)) for x in row)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return [cols[i] for i in order], sorted(out, key=_key)


def compare(spark_df, con, sql: str):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sr = rows_of(s_cols, s_rows)
    dc, dr = rows_of(d_cols, d_rows)
    problems = []
    if sc != dc:
        problems.append(f"columns differ: spark={sc} duck={dc}")
    if len(sr) != len(dr):
        problems.append(f"row count differs: spark={len(sr)} duck={len(dr)}")
    elif sr != dr:
        bad = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        problems.append(f"values differ, e.g. {bad}")
    return problems, len(sr)
