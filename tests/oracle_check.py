"""Compare registered queries with their SQL: column names, row counts and sorted values."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float, Decimal)):
        return (2, f"{float(value):.9g}" if not isinstance(value, int) else f"{float(value):.9g}")
    return (3, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when both agree, else what differs."""
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_cols, want = [d[0] for d in cur.description], cur.fetchall()
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(set(got_cols) ^ set(want_cols))}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = rows_of(got_cols, got), rows_of(want_cols, want)
    for x, y in zip(a, b):
        if x != y:
            names = sorted(got_cols)
            return f"values { {n: (p[1], q[1]) for n, p, q in zip(names, x, y) if p != q} }"
    return None
