"""Choosing, renaming and classifying columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

_NUMERIC = (T.NumericType,)


def as_list(value: str | Iterable[str] | None) -> list[str]:
    """``None`` to an empty list, a single name to a one-element list."""
    if value is None:
        return []
    return [value] if isinstance(value, str) else list(value)


def value_of(df: DataFrame, name: str) -> Column:
    """A column by its exact name, NaN as null in floating columns."""
    col = F.col("`" + name.replace("`", "``") + "`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(col), col)
    return col


def is_numeric(field: T.StructField) -> bool:
    return isinstance(field.dataType, _NUMERIC)


def is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType)


def is_datetime(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))


def drop_columns(df: DataFrame, cols: str | Iterable[str]) -> DataFrame:
    """Drop the named columns; names that do not exist are ignored."""
    return df.drop(*as_list(cols))


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by ``{old: new}``; unknown names are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def select_columns(
    df: DataFrame,
    include: str | Iterable[str] | None = None,
    exclude: str | Iterable[str] | None = None,
) -> DataFrame:
    """Keep ``include`` in the given order, or everything but ``exclude``.

    Absent names are ignored, giving both is an error, giving neither changes nothing.
    """
    include, exclude = as_list(include), as_list(exclude)
    if include and exclude:
        raise ValueError("select_columns takes include or exclude, not both")
    if include:
        return df.select(*[c for c in include if c in df.columns])
    if exclude:
        return df.select(*[c for c in df.columns if c not in exclude])
    return df


def null_shares(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Null share per column in one aggregate; an empty table has no shares."""
    if not cols:
        return {}
    row = df.agg(*[F.avg(value_of(df, c).isNull().cast("int")).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols if row[c] is not None}


def dropna_columns(
    df: DataFrame,
    cols: str | Iterable[str] | None = None,
    min_missing_ratio: float | None = None,
) -> DataFrame:
    """Drop columns by name, by null share, or by null share among the named ones.

    A ratio costs one aggregate over the candidate columns, because the output
    schema depends on the data.
    """
    named = as_list(cols)
    if min_missing_ratio is None:
        return drop_columns(df, named)
    candidates = [c for c in named if c in df.columns] if named else df.columns
    shares = null_shares(df, candidates)
    return df.drop(*[c for c, share in shares.items() if share >= float(min_missing_ratio)])


def text_columns(df: DataFrame) -> list[str]:
    """Columns treated as categorical when none are named."""
    return [f.name for f in df.schema if is_text(f)]


def feature_types(
    df: DataFrame, target: str, id_cols: Iterable[str] | None = None
) -> tuple[list[str], list[str]]:
    """Numeric and categorical feature names; the target, ids and datetimes are in neither."""
    skip = {target, *as_list(id_cols)}
    fields = [f for f in df.schema if f.name not in skip]
    numeric = [f.name for f in fields if is_numeric(f)]
    categorical = [f.name for f in fields if is_text(f) or isinstance(f.dataType, T.BooleanType)]
    return numeric, categorical


def columns_of_type(df: DataFrame, kind: str, without: Iterable[str] = ()) -> list[str]:
    """Names of ``numeric``, ``text``, ``bool`` or ``datetime`` columns, minus ``without``."""
    tests = {
        "numeric": is_numeric,
        "text": is_text,
        "bool": lambda f: isinstance(f.dataType, T.BooleanType),
        "datetime": is_datetime,
    }
    skip = set(without)
    return [f.name for f in df.schema if tests[kind](f) and f.name not in skip]


def column_difference(left: DataFrame, right: DataFrame) -> tuple[list[str], list[str]]:
    """Columns only in ``left`` and columns only in ``right``, each in table order."""
    return (
        [c for c in left.columns if c not in right.columns],
        [c for c in right.columns if c not in left.columns],
    )
