"""Query sources."""

from __future__ import annotations

import datetime as dt
import math
import os
import re
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def query_tables(
    spark: SparkSession,
    query: str,
    params: Mapping[str, Any] | None = None,
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Run SQL with bound ``:name`` parameters over frames given by name.

    Frames are referenced as ``{name}`` and need no registered view.
    """
    return spark.sql(query, args=dict(params or {}), **dict(tables or {}))


def _literal(value: Any) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, float) and not math.isfinite(value):
        raise ValueError("a number that is not finite cannot be a query parameter")
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, dt.date):
        return f"DATE '{value:%Y-%m-%d}'"
    if isinstance(value, str):
        # Some databases read a backslash as an escape, which could end the literal early.
        if "\\" in value or "\0" in value:
            raise ValueError("a query parameter may not hold a backslash or a NUL")
        return "'" + value.replace("'", "''") + "'"
    raise TypeError(f"cannot use {type(value).__name__} as a query parameter")


def bind(query: str, params: Mapping[str, Any] | None) -> str:
    """Put parameters into ``:name`` places as literals, outside quoted text."""
    given = params or {}

    def put(match: re.Match) -> str:
        if match.group(1) is None:
            return match.group(0)
        if match.group(1) not in given:
            raise KeyError(f"no value for query parameter {match.group(1)!r}")
        return _literal(given[match.group(1)])

    return re.sub(r"'(?:[^']|'')*'|\"[^\"]*\"|::|:([A-Za-z_]\w*)", put, query)


def jdbc_options(
    query: str,
    conn_env: str,
    params: Mapping[str, Any] | None = None,
    split: Mapping[str, Any] | None = None,
) -> dict[str, str]:
    """Reader options for a query on the database whose URL is in ``conn_env``.

    ``split`` (``column``, ``lower``, ``upper``, ``parts``) reads in parallel
    ranges; without it the database sends everything to one task.
    """
    url = os.environ[conn_env]
    text = bind(query.strip().rstrip(";"), params)
    if not split:
        return {"url": url, "query": text}
    return {
        "url": url,
        "dbtable": f"({text}) q",
        "partitionColumn": str(split["column"]),
        "lowerBound": str(split["lower"]),
        "upperBound": str(split["upper"]),
        "numPartitions": str(split["parts"]),
    }


def read_database(
    spark: SparkSession,
    query: str,
    conn_env: str,
    params: Mapping[str, Any] | None = None,
    split: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Read a query through JDBC; the driver jar must be on Spark's class path."""
    return spark.read.format("jdbc").options(**jdbc_options(query, conn_env, params, split)).load()
