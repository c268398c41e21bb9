"""Table profiles ("suites"): what a healthy copy of the table looked like."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lapsekit.operators.columns import as_list, is_datetime, is_numeric, is_text, value_of
from lapsekit.operators.quantiles import soft_bounds
from lapsekit.operators.stats import unpack

MAX_CATEGORIES = 50
# Twice the limit: far outside the error of the distinct estimate.
_CANDIDATE_CATEGORIES = 2 * MAX_CATEGORIES


def logical_type(field: T.StructField) -> str:
    """Type name used in profiles."""
    if isinstance(field.dataType, T.BooleanType):
        return "boolean"
    if isinstance(field.dataType, T.DecimalType):
        return "decimal"
    if isinstance(field.dataType, T.IntegralType):
        return "integer"
    if is_numeric(field):
        return "floating"
    if isinstance(field.dataType, T.DateType):
        return "date"
    if is_datetime(field):
        return "datetime64"
    return "string" if is_text(field) else "mixed"


def _low_cardinality(df: DataFrame) -> list[str]:
    """Non-numeric columns whose estimated number of values is small enough to list."""
    names = [f.name for f in df.schema if logical_type(f) in ("boolean", "date", "datetime64", "string")]
    if not names:
        return []
    row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in names]).first()
    return [c for c in names if row[c] <= _CANDIDATE_CATEGORIES]


def profile(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """One row per column.

    ``name``, ``dtype``, ``row_count``, ``null_rate``; soft bounds ``low``/``high``
    for numbers; ``categories`` for other columns with at most 50 values;
    ``earliest``/``latest`` for dates.

    Two scans: a sketch pass picks the columns whose values may be listed, so
    that the value sets in the second pass are known to be small.
    """
    df = df.select(*as_list(cols)) if cols else df
    listed = set(_low_cardinality(df))
    measures: list[Column] = [F.count(F.lit(1)).alias("rows")]
    entries: list[Column] = []
    none_text = F.lit(None).cast("array<string>")
    none_time = F.lit(None).cast("timestamp_ntz")
    for field in df.schema:
        c, kind = field.name, logical_type(field)
        measures.append(F.count(value_of(df, c)).alias(f"n_{c}"))
        categories, earliest, latest = none_text, none_time, none_time
        if c in listed:
            measures.append(F.collect_set(F.col(c).cast("string")).alias(f"set_{c}"))
            values = F.array_sort(F.col(f"`set_{c}`"))
            categories = F.when(F.size(values) <= MAX_CATEGORIES, values)
        if kind in ("date", "datetime64"):
            measures += [F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}")]
            earliest = F.col(f"`lo_{c}`").cast("timestamp_ntz")
            latest = F.col(f"`hi_{c}`").cast("timestamp_ntz")
        present = F.col(f"`n_{c}`")
        entries.append(
            F.struct(
                F.lit(c).alias("name"),
                F.when(present == 0, "empty").otherwise(kind).alias("dtype"),
                F.col("rows").alias("row_count"),
                F.try_divide((F.col("rows") - present).cast("double"), F.col("rows")).alias("null_rate"),
                categories.alias("categories"),
                earliest.alias("earliest"),
                latest.alias("latest"),
            )
        )
    columns = unpack(df.agg(*measures), entries)
    numeric = [f.name for f in df.schema if is_numeric(f)]
    if numeric:
        # One row per numeric column.
        columns = columns.join(F.broadcast(soft_bounds(df, numeric)), "name", "left")
    else:
        columns = columns.withColumns({b: F.lit(None).cast("double") for b in ("low", "high")})
    return columns.select(
        "name", "dtype", "row_count", "null_rate", "low", "high", "categories", "earliest", "latest"
    )


def suite_from_profile(profiled: DataFrame) -> dict[str, Any]:
    """The profile as the nested dictionary :func:`validate` takes; one row per column is fetched."""
    columns: dict[str, Any] = {}
    row_count = 0
    for row in profiled.toArrow().to_pylist():
        info: dict[str, Any] = {"dtype": row["dtype"], "null_rate": row["null_rate"] or 0.0}
        if row["low"] is not None:
            info["num_bounds"] = {"low": row["low"], "high": row["high"]}
        if row["categories"] is not None:
            info["categories"] = row["categories"]
        if row["earliest"] is not None:
            info["datetime_bounds"] = {"low": str(row["earliest"]), "high": str(row["latest"])}
        columns[row["name"]] = info
        row_count = row["row_count"]
    return {"columns": columns, "row_count": row_count}


def save_suite(spark: SparkSession, suite: Mapping[str, Any], path: str) -> None:
    """Write a suite as JSON text to any file system Spark can reach."""
    text = json.dumps(suite, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_suite(spark: SparkSession, path: str) -> dict[str, Any]:
    """Read a suite written by :func:`save_suite` or any JSON file of that shape."""
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


def profile_many(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Profiles of several tables, with the table's name in ``dataset``."""
    result = None
    for dataset, df in tables.items():
        part = profile(df).select(F.lit(dataset).alias("dataset"), "*")
        result = part if result is None else result.unionByName(part)
    if result is None:
        raise ValueError("no tables given")
    return result
