"""Compare a query with its SQL oracle, column by column in name order."""

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
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v


def as_bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, con, sql):
    """None when equal, otherwise a short text."""
    cols, got = as_bag(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = as_bag([c[0] for c in cur.description], cur.fetchall())
    if cols != want_cols:
        return f"columns {cols} != {want_cols}"
    if got != want:
        return (
            f"{sum(got.values())} rows vs {sum(want.values())}; "
            f"extra {list((got - want).items())[:3]}; missing {list((want - got).items())[:3]}"
        )
    return None
