"""Queries on a database through its Python driver, with values bound by that driver.

A Spark data source over the standard Python database interface: the query's ``:name`` parameters and the filters
Spark pushes down travel as bound values, never as text; a split column deals the rows over tasks, each with a
connection of its own.
"""

from __future__ import annotations

import datetime as dt
import json
import math
import os
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from importlib import import_module
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual,
)
from pyspark.sql.types import StructType

FETCHED = 10_000
_COMPARED = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
_PLACES = {"qmark": "?", "format": "%s"}


def bound(query: str, params: Mapping[str, Any], style: str = "qmark") -> tuple[str, Any]:
    """The query with the driver's own placeholders for ``:name`` (outside quoted text), and the values it is to bind."""
    if style not in (*_PLACES, "numeric", "named", "pyformat"):
        raise ValueError(f"unknown parameter style {style!r}")
    values: list[Any] = []

    def put(match: re.Match) -> str:
        name = match.group(1)
        if name is None:
            return match.group(0)
        if name not in params:
            raise KeyError(f"no value for query parameter {name!r}")
        values.append(params[name])
        return _PLACES.get(style) or {"numeric": f":{len(values)}", "named": f":{name}", "pyformat": f"%({name})s"}[style]

    text = query.replace("%", "%%") if style in ("format", "pyformat") else query
    text = re.sub(r"'(?:[^']|'')*'|\"[^\"]*\"|::|:([A-Za-z_]\w*)", put, text)
    return text, dict(params) if style in ("named", "pyformat") else values


def _name(column: str) -> str:
    return column if re.fullmatch(r"[A-Za-z_]\w*", column) else '"' + column.replace('"', '""') + '"'


def _can_bind(value: Any) -> bool:
    return isinstance(value, (int, str, dt.date)) or (isinstance(value, float) and math.isfinite(value))


def condition(found: Filter, names: Iterator[str]) -> tuple[str, dict[str, Any]] | None:
    """A pushed filter as SQL with parameters, or ``None`` where the database might see it differently."""
    if len(found.attribute if hasattr(found, "attribute") else ()) != 1:
        return None
    column = _name(found.attribute[0])
    if isinstance(found, (IsNull, IsNotNull)):
        return f"{column} IS {'NOT ' if isinstance(found, IsNotNull) else ''}NULL", {}
    if type(found) in _COMPARED and _can_bind(found.value):
        name = next(names)
        return f"{column} {_COMPARED[type(found)]} :{name}", {name: found.value}
    if isinstance(found, In) and found.value and all(_can_bind(v) for v in found.value):
        given = {next(names): v for v in found.value}
        return f"{column} IN ({', '.join(f':{n}' for n in given)})", given
    return None


@dataclass
class Range(InputPartition):
    """Rows of one task: ``low <= column < high``; the first one also has the nulls and all below, the last all above."""

    low: float | None = None
    high: float | None = None


def ranges(lower: float, upper: float, parts: int) -> list[Range]:
    if parts < 1 or not lower < upper:
        raise ValueError("a split needs lower < upper and at least one part")
    cuts = sorted({lower + (upper - lower) * i // parts if isinstance(lower, int) else lower + (upper - lower) * i / parts for i in range(1, parts)})
    cuts = [c for c in cuts if c > lower]
    return [Range(low, high) for low, high in zip([None, *cuts], [*cuts, None])]


class DbApiReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str], schema: StructType) -> None:
        self.options, self.schema, self.pushed = dict(options), schema, []
        self.params = json.loads(self.options.get("params") or "{}")
        self.split = json.loads(self.options.get("split") or "null")

    def pushFilters(self, filters: Sequence[Filter]) -> Iterator[Filter]:
        """Take what the database can answer; yield the rest back to Spark."""
        names = (f"pushed_{i}" for i in range(1 << 30))
        for found in filters:
            sql = condition(found, names)
            if sql is None:
                yield found
            else:
                self.pushed.append(sql)

    def partitions(self) -> list[Range]:
        return ranges(self.split["lower"], self.split["upper"], int(self.split["parts"])) if self.split else [Range()]

    def statement(self, part: Range) -> tuple[str, Any]:
        """What a task sends, and the values the driver binds."""
        wanted, params = [sql for sql, _ in self.pushed], dict(self.params)
        for _, given in self.pushed:
            params |= given
        column = _name(self.split["column"]) if self.split else ""
        if part.low is not None:
            wanted.append(f"{column} >= :split_low")
            params["split_low"] = part.low
        if part.high is not None:
            above = f"{column} < :split_high"
            wanted.append(above if part.low is not None else f"({above} OR {column} IS NULL)")
            params["split_high"] = part.high
        columns = ", ".join(_name(f.name) for f in self.schema.fields)
        where = f" WHERE {' AND '.join(wanted)}" if wanted else ""
        query = self.options["query"].strip().rstrip(";")
        return bound(f"SELECT {columns} FROM ({query}) q{where}", params, self.options.get("paramstyle", "qmark"))

    def read(self, partition: Range) -> Iterator[tuple]:
        module, _, function = self.options["connect"].partition(":")
        connection = getattr(import_module(module), function or "connect")(self.options["url"])
        try:
            cursor = connection.cursor()
            cursor.execute(*self.statement(partition))
            while rows := cursor.fetchmany(FETCHED):
                yield from map(tuple, rows)
        finally:
            connection.close()


class DbApiSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "dbapi"

    def reader(self, schema: StructType) -> DbApiReader:
        return DbApiReader(self.options, schema)


def read_bound(
    spark: SparkSession,
    query: str,
    schema: str | StructType,
    connect: str,
    conn_env: str,
    params: Mapping[str, Any] | None = None,
    split: Mapping[str, Any] | None = None,
    paramstyle: str = "qmark",
) -> DataFrame:
    """A query's rows as a frame of the given schema.

    ``connect`` is the driver's connect function as ``module:function``, called with the URL in the environment variable
    ``conn_env``; it must be importable on every executor. ``params`` are the values of ``:name`` places (whatever JSON
    can hold). ``split`` (``column``, ``lower``, ``upper``, ``parts``) reads in that many tasks; rows outside the bounds
    and nulls belong to the outer parts. Comparisons in later filters are answered by the database.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DbApiSource)
    options = {"query": query, "connect": connect, "url": os.environ[conn_env], "params": json.dumps(dict(params or {})), "paramstyle": paramstyle}
    if split:
        options["split"] = json.dumps(dict(split))
    return spark.read.format("dbapi").schema(schema).options(**options).load()
