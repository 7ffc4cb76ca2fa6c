"""Compare registered queries with their DuckDB statements (order-insensitive)."""

from __future__ import annotations

import math
import datetime as dt

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_key(rows):
    return sorted((tuple(_norm(v) for v in r) for r in rows), key=repr)


def compare(spark_df, con, sql):
    cols = sorted(spark_df.columns)
    s_rows = [tuple(r[c] for c in cols) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    if sorted(d_cols) != cols:
        return False, f"columns differ: spark={cols} duck={sorted(d_cols)}"
    d_rows = rel.select(*[f'"{c}"' for c in cols]).fetchall()
    a, b = rows_key(s_rows), rows_key(d_rows)
    if len(a) != len(b):
        return False, f"row count spark={len(a)} duck={len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return False, f"first diff: spark={x} duck={y}"
    return True, f"{len(a)} rows"
