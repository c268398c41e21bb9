"""Row order made explicit.

Spark rows have no position, so every "first" or "last" needs an order key.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lapsekit.operators.columns import as_list


def _hashable(data_type: T.DataType) -> bool:
    return not isinstance(data_type, (T.MapType, T.VariantType))


def order_key(df: DataFrame, order_by: str | Iterable[str] | None) -> Column:
    """The value rows are ordered by.

    Named columns are compared in turn, nulls last; they should be unique within a group.
    Without names the key is a 64-bit hash of the whole row: eight bytes wide,
    the same on every partitioning, and equal only for identical rows. That
    order is stable but arbitrary.
    """
    names = as_list(order_by)
    if names:
        # A bare null key would be skipped by min_by and max_by; a pair with a flag never is, and sorts nulls last.
        return F.struct(*[p for i, c in enumerate(names) for p in (F.col(c).isNull().alias(f"null{i}"), F.col(c).alias(f"value{i}"))])
    return F.xxhash64(*[F.col(f.name) for f in df.schema if _hashable(f.dataType)])


def top_k(df: DataFrame, cols: str | Sequence[str], k: int, largest: bool = True) -> DataFrame:
    """Rows with the largest or smallest values, nulls last.

    ``orderBy`` plus ``limit`` keeps k rows per task and merges those.
    """
    names = as_list(cols)
    if largest:
        return df.orderBy(*[F.col(c).desc_nulls_last() for c in names]).limit(k)
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in names]).limit(k)


def sort_rows(df: DataFrame, cols: str | Sequence[str], ascending: bool = True) -> DataFrame:
    """Total sort, nulls last; range-partitioned over the cluster."""
    names = as_list(cols)
    return df.orderBy(*[F.col(c).asc_nulls_last() if ascending else F.col(c).desc_nulls_last() for c in names])
