"""Schema-driven type casting with a report.

A schema is ``{column: {"type": ..., options}}`` with types string, int, float,
bool, datetime and category.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lapsekit.functions import casts
from lapsekit.functions.timing import parse_datetime, to_utc_naive
from lapsekit.operators.columns import is_datetime
from lapsekit.operators.stats import unpack

Spec = Mapping[str, Any]
MODES = ("strict", "coerce")


class CastError(ValueError):
    """Values that do not fit the declared type."""


@dataclass
class _Plan:
    """The cast of one column and the test for values the mode does not accept."""

    value: Column
    refused: Column


def check_columns(df: DataFrame, schema: Mapping[str, Spec], keep_unknown: bool = False) -> None:
    """Compare the column set with the schema; no job is run."""
    missing = sorted(set(schema) - set(df.columns))
    unknown = sorted(set(df.columns) - set(schema))
    if missing:
        raise CastError(f"missing columns: {missing}")
    if unknown and not keep_unknown:
        raise CastError(f"unknown columns: {unknown}; set keep_unknown to pass them through")


def _datetime(field: T.StructField, spec: Spec) -> Column:
    col, drop_tz = F.col(field.name), bool(spec.get("drop_tz", False))
    if is_datetime(field):
        if isinstance(field.dataType, T.TimestampType):
            return to_utc_naive(col) if drop_tz else col
        return col.cast("timestamp_ntz")
    return parse_datetime(col, spec.get("format"), drop_tz)


def _is_number(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.NumericType, T.BooleanType)) and not isinstance(field.dataType, T.DecimalType)


def _int(field: T.StructField, truncate: bool) -> Column:
    """Numbers and booleans are cast as they are; anything else goes through its text."""
    if not _is_number(field):
        return casts.to_int(F.col(field.name), truncate=truncate)
    whole = isinstance(field.dataType, (T.IntegralType, T.BooleanType))
    return casts.number_to_int(F.col(field.name), whole, truncate)


def _plan_column(field: T.StructField, spec: Spec, mode: str) -> _Plan:
    col, kind = F.col(field.name), spec["type"]
    nothing = F.lit(False)
    if kind == "string":
        return _Plan(casts.to_string(col), nothing)
    if kind == "category":
        return _Plan(casts.to_category(col, spec.get("categories")), nothing)
    if kind == "int":
        nullable = spec.get("nullable", True)
        value = _int(field, not nullable)
        if not nullable:
            return _Plan(value, value.isNull())
        refused = col.isNotNull() & value.isNull()
        # A fraction fits no nullable integer in either mode unless asked otherwise.
        if mode == "coerce":
            refused = casts.has_fraction(col) if spec.get("on_fraction") == "error" else nothing
        return _Plan(value, refused)
    if kind == "float":
        value = casts.number_to_float(col) if _is_number(field) else casts.to_float(col)
    elif kind == "bool":
        value = casts.to_bool(col)
        return _Plan(value, value.isNull() if mode == "strict" else nothing)
    elif kind == "datetime":
        value = _datetime(field, spec)
    else:
        raise CastError(f"unsupported type for {field.name}: {kind!r}")
    return _Plan(value, col.isNotNull() & value.isNull() if mode == "strict" else nothing)


def _plans(df: DataFrame, schema: Mapping[str, Spec], mode: str) -> dict[str, _Plan]:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    return {c: _plan_column(df.schema[c], spec, mode) for c, spec in schema.items()}


def _enforce(df: DataFrame, plans: Mapping[str, _Plan], schema: Mapping[str, Spec], mode: str) -> None:
    """One aggregate over all columns that could be refused; raise with counts and examples."""
    checked = [
        c
        for c in plans
        if mode == "strict" and schema[c]["type"] not in ("string", "category")
        or (schema[c]["type"] == "int" and (not schema[c].get("nullable", True) or schema[c].get("on_fraction") == "error"))
    ]
    if not checked:
        return
    measures = []
    for i, c in enumerate(checked):
        bad = F.when(plans[c].refused, F.coalesce(F.col(c).cast("string"), F.lit("<null>")))
        measures += [
            F.count_if(plans[c].refused).alias(f"n{i}"),
            F.min(bad).alias(f"lo{i}"),
            F.max(bad).alias(f"hi{i}"),
        ]
    row = df.agg(*measures).first()
    problems = [
        f"{c}: {row[f'n{i}']} values do not fit {schema[c]['type']} (e.g. {row[f'lo{i}']!r}, {row[f'hi{i}']!r})"
        for i, c in enumerate(checked)
        if row[f"n{i}"]
    ]
    if problems:
        raise CastError("; ".join(problems))


def cast_table(
    df: DataFrame,
    schema: Mapping[str, Spec],
    mode: str = "strict",
    keep_unknown: bool = False,
) -> DataFrame:
    """Cast all columns of the schema in one projection; column order is kept.

    ``coerce`` turns misfits into nulls and stays lazy. ``strict`` first runs one
    aggregate that raises :class:`CastError` naming every column with misfits.
    Non-nullable integers are checked in both modes and truncate fractions.
    """
    check_columns(df, schema, keep_unknown)
    plans = _plans(df, schema, mode)
    _enforce(df, plans, schema, mode)
    return df.select(*[plans[c].value.alias(c) if c in plans else F.col(c) for c in df.columns])


def cast_report(df: DataFrame, schema: Mapping[str, Spec]) -> DataFrame:
    """``name``, ``new_missing``: nulls the cast would create, for columns that have any.

    One aggregate for all columns.
    """
    plans = _plans(df, schema, "coerce")
    row = df.agg(
        *[F.count_if(F.col(c).isNotNull() & plan.value.isNull()).alias(c) for c, plan in plans.items()]
    )
    entries = [F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").alias("new_missing")) for c in plans]
    return unpack(row, entries).filter("new_missing > 0")


def cast_many(
    tables: Mapping[str, DataFrame],
    specs: Mapping[str, Mapping[str, Any]],
    defaults: Mapping[str, Any] | None = None,
    fail_fast: bool = True,
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Cast several tables; returns the cast frames and an error per failed table.

    A spec is ``{"schema": ..., "mode": ..., "keep_unknown_columns": ...}``; its
    entries win over ``defaults``.
    """
    done: dict[str, DataFrame] = {}
    errors: dict[str, str] = {}
    for name, spec in specs.items():
        options = {**(defaults or {}), **spec}
        try:
            done[name] = cast_table(
                tables[name],
                options["schema"],
                options.get("mode", "strict"),
                bool(options.get("keep_unknown_columns", False)),
            )
        except Exception as error:
            if fail_fast:
                raise
            errors[name] = str(error)
    return done, errors
