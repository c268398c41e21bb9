"""Filtering, cleaning and de-duplicating rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, functions as F, types as T

from lapsekit.operators.columns import as_list, text_columns
from lapsekit.operators.ordering import order_key
from lapsekit.operators.quantiles import quantile_column


def dropna_rows(
    df: DataFrame,
    subset: str | Iterable[str] | None = None,
    how: str = "any",
    thresh: int | None = None,
) -> DataFrame:
    """Drop rows with nulls; ``thresh`` is the least number of present values and overrides ``how``."""
    names = as_list(subset) or None
    if thresh is not None:
        return df.dropna(thresh=int(thresh), subset=names)
    return df.dropna(how=how, subset=names)


def drop_duplicates(
    df: DataFrame,
    subset: str | Iterable[str] | None = None,
    keep: str | bool = "first",
    order_by: str | Iterable[str] | None = None,
) -> DataFrame:
    """Remove repeated rows; nulls count as equal.

    ``keep`` is ``"first"``, ``"last"`` or ``False`` (drop every repeated row).
    All forms are grouped aggregates, so copies of a hot key are merged inside
    each map task before anything is shuffled.
    """
    if keep not in ("first", "last", False):
        raise ValueError(f"keep must be 'first', 'last' or False, not {keep!r}")
    names = [] if subset == "all" else as_list(subset)
    whole_row = not names or set(names) == set(df.columns)
    if whole_row and keep is not False:
        return df.dropDuplicates()
    keys = df.columns if whole_row else names
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        kept = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__copies"))
        return kept.filter("__copies = 1").select(*df.columns)
    payload = F.struct(*[F.col(c) for c in rest])
    if keep is False:
        # A group of one has only one candidate, so "any" is exact after the filter.
        kept = df.groupBy(*keys).agg(
            F.any_value(payload).alias("__row"), F.count(F.lit(1)).alias("__copies")
        ).filter("__copies = 1")
    else:
        pick = F.min_by if keep == "first" else F.max_by
        kept = df.groupBy(*keys).agg(pick(payload, order_key(df, order_by)).alias("__row"))
    return kept.select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])


def filter_not_equal(df: DataFrame, col: str, value: Any) -> DataFrame:
    """Drop rows equal to ``value``; null rows stay."""
    return df.filter(~F.col(col).eqNullSafe(F.lit(value)))


def filter_below(df: DataFrame, col: str, value: Any) -> DataFrame:
    """Keep rows under ``value``."""
    return df.filter(F.col(col) < F.lit(value))


def filter_members(df: DataFrame, col: str, values: Iterable[Any]) -> DataFrame:
    """Keep rows whose value is in the list."""
    return df.filter(F.col(col).isin(list(values)))


def filter_below_quantile(df: DataFrame, col: str, probability: float = 0.5) -> DataFrame:
    """Keep rows strictly under the column's own quantile."""
    return df.filter(F.col(col) < quantile_column(df, col, probability))


def single_valued_groups(df: DataFrame, key: str | Iterable[str], col: str) -> DataFrame:
    """Rows of the groups with exactly one distinct present value in ``col``.

    One distinct value means smallest equals largest, which is one partial
    aggregate; a distinct count would shuffle every (key, value) pair first.
    """
    keys = as_list(key)
    uniform = (
        df.groupBy(*keys)
        .agg(F.min(col).alias("__lo"), F.max(col).alias("__hi"))
        .filter(F.col("__lo") == F.col("__hi"))
        .select(*keys)
    )
    return df.join(uniform, keys, "left_semi")


def ambiguous_values(df: DataFrame, col: str, by: str) -> DataFrame:
    """Distinct values of ``col`` seen with more than one value of ``by``."""
    return (
        df.filter(F.col(col).isNotNull() & F.col(by).isNotNull())
        .groupBy(col)
        .agg((F.min(by) != F.max(by)).alias("__several"))
        .filter("__several")
        .select(col)
    )


def conflicting_pairs(df: DataFrame, col: str, by: str) -> DataFrame:
    """Sorted distinct (``col``, ``by``) pairs of the ambiguous values.

    Pairs are made distinct first, so the join runs on the reduced table.
    """
    pairs = df.filter(F.col(col).isNotNull() & F.col(by).isNotNull()).select(col, by).distinct()
    return pairs.join(ambiguous_values(pairs, col, by), col, "left_semi").select(col, by).orderBy(col, by)


def fill_null(df: DataFrame, value: int | float = 0, include_text: bool = True) -> DataFrame:
    """Replace nulls by a constant in numeric and, as text, in string columns."""
    filled = df.fillna(value)
    return filled.fillna(str(value)) if include_text else filled


def replace_values(df: DataFrame, mapping: Mapping[Any, Any], cols: Iterable[str] | None = None) -> DataFrame:
    """Replace whole values by ``{old: new}`` in the given (default: all text) columns."""
    names = as_list(cols) or text_columns(df)
    return df.replace(dict(mapping), subset=names) if names else df


def disambiguate_city_state(
    df: DataFrame,
    city_col: str,
    state_col: str,
    suffix_sep: str = "_",
) -> DataFrame:
    """Append the state to the names of cities that occur in several states.

    Rows of such a city without a state get a null city. The table is returned
    unchanged if either column is absent.

    The ambiguous cities come from a grouped aggregate: a dominant city is merged
    map-side, never gathered in one window. They are one row per distinct city name,
    so they are broadcast: a join shuffled by the city would put all rows of a city in
    one task, and the adaptive planner keeps that shuffle when few or no cities are
    ambiguous. Nothing runs while the plan is built.
    """
    if city_col not in df.columns or state_col not in df.columns:
        return df
    several = ambiguous_values(df, city_col, state_col).withColumnRenamed(city_col, "__city")
    marked = F.broadcast(several.withColumn("__several", F.lit(True)))
    full_name = F.concat(F.col(city_col).cast("string"), F.lit(suffix_sep), F.col(state_col).cast("string"))
    renamed = F.when(F.col("__several"), full_name).otherwise(F.col(city_col))
    joined = df.join(marked, F.col(city_col) == F.col("__city"), "left")
    return joined.select(*[renamed.alias(c) if c == city_col else F.col(c) for c in df.columns])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Make NaN and null one concept in every floating column."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating}) if floating else df


