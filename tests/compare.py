"""Run registered queries and their SQL side by side."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    """A value as comparable text."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql) -> list[str]:
    """What differs between a Spark result and the SQL result."""
    ours, our_cols = df.collect(), df.columns
    found = con.execute(sql)
    cols = [d[0] for d in found.description]
    theirs = found.fetchall()
    if sorted(our_cols) != sorted(cols):
        return [f"columns {sorted(our_cols)} vs {sorted(cols)}"]
    mine, other = rows_of(our_cols, ours), rows_of(cols, theirs)
    if not other:
        return ["no rows"]
    notes = [] if len(mine) == len(other) else [f"{len(mine)} rows vs {len(other)}"]
    a, b = set(mine), set(other)
    if mine != other:
        notes += [f"ours  {x}" for x in sorted(a - b)[:3]]
        notes += [f"theirs {x}" for x in sorted(b - a)[:3]]
        notes.append(f"{len(a - b)} and {len(b - a)} rows differ ({sorted(cols)})")
    if any("-0.0" in row for row in mine + other):
        notes.append("negative zero")
    return notes
