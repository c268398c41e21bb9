"""Grouped aggregates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lapsekit.operators.columns import as_list, value_of
from lapsekit.operators.ordering import order_key


_POSITION = "__position"


def _group_sum(df: DataFrame, col: str) -> Column:
    """Sum that is 0, not null, for a group without values."""
    wide = isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType))
    return F.coalesce(F.sum(value_of(df, col)), F.lit(0.0 if wide else 0))


def groupby_aggregate(
    df: DataFrame,
    by: str | Iterable[str],
    sum_cols: Iterable[str] | None = None,
    mean_cols: Iterable[str] | None = None,
    min_cols: Iterable[str] | None = None,
    first_for_rest: bool = True,
    order_by: str | Iterable[str] | None = None,
) -> DataFrame:
    """One row per key with sums, means, minima and, for the rest, the first present value.

    Null keys form groups; NaN is a missing value. A column listed twice takes the later of sum, mean,
    min. "First" follows ``order_by`` (see :func:`order_key`). Everything is one
    partial aggregate and one shuffle on the keys.
    """
    keys = as_list(by)
    plan: dict[str, Column] = {}
    plan.update({c: _group_sum(df, c) for c in as_list(sum_cols)})
    plan.update({c: F.avg(value_of(df, c)) for c in as_list(mean_cols)})
    plan.update({c: F.min(value_of(df, c)) for c in as_list(min_cols)})
    if first_for_rest:
        rest = [c for c in df.columns if c not in keys and c not in plan]
        # A null order value is ignored, which makes this the first non-null value.
        plan.update({c: F.min_by(F.col(c), F.when(value_of(df, c).isNotNull(), F.col(_POSITION))) for c in rest})
        # The order key is made once per row, not once per column.
        df = df.withColumn(_POSITION, order_key(df, order_by)) if rest else df
    if not plan:
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(*[value.alias(c) for c, value in plan.items()])


def amounts_per_key(df: DataFrame, key: str, amount: str) -> DataFrame:
    """Total, largest and number of present amounts per key."""
    return df.groupBy(key).agg(
        F.coalesce(F.sum(amount), F.lit(0.0)).alias("total"),
        F.max(amount).alias("largest"),
        F.count(amount).alias("n"),
    )


def distinct_per_group(df: DataFrame, key: str | Iterable[str], col: str, name: str = "n_distinct") -> DataFrame:
    """Number of distinct present values per key; null keys are dropped.

    The pairs are made distinct by a partial aggregate first, so a hot key
    shuffles its distinct values and not its rows.
    """
    keys = as_list(key)
    present = df.dropna(subset=keys)
    pairs = present.select(*keys, col).distinct()
    return pairs.groupBy(*keys).agg(F.count(col).alias(name))


def value_counts(df: DataFrame, col: str, normalize: bool = False, name: str | None = None) -> DataFrame:
    """Rows per value, largest first, nulls left out; with ``normalize`` the share of the present rows."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("__n"))
    if not normalize:
        return counts.withColumnRenamed("__n", name or "count").orderBy(F.desc(name or "count"), col)
    present = df.agg(F.count(col)).scalar()
    share = F.try_divide(F.col("__n").cast("double"), present)
    return counts.select(col, share.alias(name or "share")).orderBy(F.desc(name or "share"), col)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values, null included."""
    return df.select(col).distinct()


def distinct_counts(df: DataFrame, cols: Iterable[str], approximate: bool = False) -> DataFrame:
    """Number of distinct present values per column: ``name``, ``n_distinct``.

    Exact counting is one aggregate with a distinct count per column, which Spark
    expands to one row per column and value; ``approximate`` answers from one sketch
    per column in a single pass.
    """
    names = as_list(cols)
    if approximate:
        row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in names])
        entries = [F.struct(F.lit(c).alias("name"), F.col(c).alias("n_distinct")) for c in names]
        return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    row = df.agg(*[F.count_distinct(c).alias(c) for c in names])
    entries = [F.struct(F.lit(c).alias("name"), F.col(c).alias("n_distinct")) for c in names]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
