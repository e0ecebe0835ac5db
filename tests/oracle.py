"""Side-by-side check of a Spark result against DuckDB SQL (test helper)."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, repr(x)) for x in row)


def compare(spark_df, sql: str, sf_dir: str, con=None):
    """Return (ok, message) comparing column names and row multisets."""
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    d_cols = [c for c in rel.columns]
    d_rows = rel.fetchall()
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    if sorted(c.lower() for c in d_cols) != sorted(c.lower() for c in s_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    order = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(r[i] for i in order) for r in d_rows]
    a = sorted((tuple(_norm(x) for x in r) for r in s_rows), key=_key)
    b = sorted((tuple(_norm(x) for x in r) for r in d_rows), key=_key)
    if len(a) != len(b):
        return False, f"row counts differ: spark={len(a)} duck={len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return False, f"first difference: spark={x} duck={y}"
    return True, f"{len(a)} rows equal"
