"""Compare a Spark result with its SQL counterpart run by DuckDB on the same files."""

from __future__ import annotations

import collections
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    return "NaN" if isinstance(v, float) and math.isnan(v) else v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple((type(r[i]).__name__, _value(r[i])) for i in order) for r in data)


def compare(df, con, sql: str) -> str | None:
    """None when columns, types and rows agree, otherwise what differs."""
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    want, got = rows(columns, cur.fetchall()), rows(df.columns, [tuple(r) for r in df.collect()])
    if want != got:
        extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"{sum(got.values())} rows against {sum(want.values())}; spark only {extra}; sql only {missing}"
    return None
