"""Aggregates across the columns of one row; all of them skip nulls."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def _plus(a: Column, b: Column) -> Column:
    return a + b


def _filled(cols: Sequence[Column], value: int) -> list[Column]:
    return [F.coalesce(c, F.lit(value)) for c in cols]


def present_count(cols: Sequence[Column]) -> Column:
    return reduce(_plus, [c.isNotNull().cast("int") for c in cols]).cast("bigint")


def row_sum(cols: Sequence[Column]) -> Column:
    """Sum of the present values; 0 when all are null."""
    return reduce(_plus, _filled(cols, 0))


def row_mean(cols: Sequence[Column]) -> Column:
    return F.try_divide(row_sum(cols).cast("double"), present_count(cols))


def row_min(cols: Sequence[Column]) -> Column:
    return cols[0] if len(cols) == 1 else F.least(*cols)


def row_max(cols: Sequence[Column]) -> Column:
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


def row_prod(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a * b, _filled(cols, 1))


def row_nunique(cols: Sequence[Column]) -> Column:
    return F.size(F.array_distinct(F.array_compact(F.array(*cols)))).cast("bigint")


def row_any(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(c.cast("boolean"), F.lit(False)) for c in cols])


def row_all(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [F.coalesce(c.cast("boolean"), F.lit(True)) for c in cols])


def row_var(cols: Sequence[Column]) -> Column:
    """Sample variance; null with fewer than two present values."""
    mean = row_mean(cols)
    squares = reduce(_plus, [F.coalesce((c - mean) * (c - mean), F.lit(0.0)) for c in cols])
    n = present_count(cols)
    return F.when(n > 1, F.try_divide(squares, n - 1))


def row_std(cols: Sequence[Column]) -> Column:
    return F.sqrt(row_var(cols))


def row_median(cols: Sequence[Column]) -> Column:
    ordered = F.array_sort(F.array_compact(F.array(*[c.cast("double") for c in cols])))
    n = F.size(ordered)
    low, high = F.floor((n - 1) / 2).cast("int"), F.floor(n / 2).cast("int")
    return F.when(n > 0, (F.get(ordered, low) + F.get(ordered, high)) / 2)


ROW_AGGREGATES: dict[str, Callable[[Sequence[Column]], Column]] = {
    "sum": row_sum,
    "mean": row_mean,
    "min": row_min,
    "max": row_max,
    "count": present_count,
    "nunique": row_nunique,
    "prod": row_prod,
    "any": row_any,
    "all": row_all,
    "std": row_std,
    "var": row_var,
    "median": row_median,
}
