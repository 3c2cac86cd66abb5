"""Row-for-row comparison of a Spark result with the same query in SQL over the test tables."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return str(v)


def as_bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None where both agree in column names and rows, else a short description."""
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    ours, theirs = as_bag(df.columns, df.collect()), as_bag(names, cursor.fetchall())
    if ours == theirs:
        return None
    mine, other = list((ours - theirs).items())[:2], list((theirs - ours).items())[:2]
    return f"rows {sum(ours.values())} vs {sum(theirs.values())}; only spark {mine}; only sql {other}"
