"""Comparing a Spark result with another engine's answer to the same question."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{Path(sf_dir) / name}.parquet')")
    return con


def plain(value):
    """A value both engines spell the same way."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, Decimal)):
        number = float(value)
        return None if math.isnan(number) else number + 0.0
    if isinstance(value, (dt.datetime, dt.date)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return str(value)


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(table, key=repr)


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """``None`` when equal, else what differs."""
    mine = canonical(df.columns, [tuple(r) for r in df.collect()])
    answer = con.execute(sql)
    theirs = canonical([c[0] for c in answer.description], answer.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows != {len(theirs[1])}"
    wrong = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    return f"{len(wrong)} rows differ, e.g. {wrong[0]}" if wrong else None
