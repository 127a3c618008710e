"""Compare a Spark DataFrame with a DuckDB query over the driver's parquet tables.

Order-insensitive: columns sorted by name, rows rendered as text and sorted.
Floats are rounded to 9 significant digits so summation order does not matter.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.9g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """Return None when equal, else a short description of the first difference."""
    s_cols = df.columns
    s_rows = rows_of(s_cols, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = rows_of(d_cols, res.fetchall())
    if sorted(s_cols) != sorted(d_cols):
        return f"columns differ: spark {sorted(s_cols)} duckdb {sorted(d_cols)}"
    if len(s_rows) != len(d_rows):
        return f"row count differs: spark {len(s_rows)} duckdb {len(d_rows)}"
    for a, b in zip(s_rows, d_rows):
        if a != b:
            return f"first differing row: spark {a} duckdb {b}"
    return None
