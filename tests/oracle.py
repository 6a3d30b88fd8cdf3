"""Side-by-side check of a Spark query against its DuckDB oracle.

Mirrors the driver's gate: same column names, same row count, same multiset
of rows (order-insensitive), floats compared after rounding.
"""

from __future__ import annotations

import math
import os

import duckdb

from gridloom.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows]


_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_types = dict(spark_df.dtypes)
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = {c: str(t) for c, t in zip(d_cols, rel.types)}
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    bad = {c: (s_types[c], t) for c, t in d_types.items() if _TYPES.get(t, t) != s_types[c]}
    if bad:
        return False, f"column types differ (spark, duck): {bad}"
    a = sorted(rows_of(s_cols, s_rows), key=repr)
    b = sorted(rows_of(d_cols, d_rows), key=repr)
    if len(a) != len(b):
        return False, f"row count spark={len(a)} duck={len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} rows differ, e.g. spark={bad[0][0]} duck={bad[0][1]}"
    return True, f"{len(a)} rows match"
