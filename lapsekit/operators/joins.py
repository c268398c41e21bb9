"""Equi-joins with the key and naming rules of a data-frame merge."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lapsekit.operators.columns import as_list

HOWS = ("left", "inner", "outer", "right")


class JoinKeyError(ValueError):
    """The right side repeats a key that was declared unique."""


def join(
    left: DataFrame,
    right: DataFrame,
    on: str | Iterable[str] | None = None,
    how: str = "left",
    left_on: str | Iterable[str] | None = None,
    right_on: str | Iterable[str] | None = None,
    select: Iterable[str] | None = None,
    suffix_right: str = "_r",
    validate: str | None = None,
) -> DataFrame:
    """Join on equal keys, where a null key equals a null key.

    With ``on`` each key appears once. With ``left_on``/``right_on`` both key
    columns are kept. ``select`` lists the right-hand columns wanted besides the
    keys, absent names ignored. A right-hand name that the left already has gets
    ``suffix_right``; a name that still clashes is an error. ``validate="m:1"``
    runs a job that fails if the right side repeats a key.

    No side is hinted: the adaptive planner broadcasts one whose measured size
    allows it and else splits hot keys on the preserved side. It cannot split a full
    outer join, so that one is a left join plus the right rows without a partner,
    which reads both sides twice.
    """
    if how not in HOWS:
        raise ValueError(f"how must be one of {HOWS}, not {how!r}")
    if on is not None:
        left_keys = right_keys = as_list(on)
    else:
        left_keys, right_keys = as_list(left_on), as_list(right_on)
    if not left_keys or len(left_keys) != len(right_keys):
        raise ValueError("join needs 'on', or 'left_on' and 'right_on' of equal length")
    # A key of the same name on both sides is one output column, however it was given.
    shared = {k for k, r in zip(left_keys, right_keys) if k == r}

    if select:
        wanted = list(dict.fromkeys([*right_keys, *select]))
        right = right.select(*[c for c in wanted if c in right.columns])
    if validate == "m:1":
        check_unique(right, right_keys)
    elif validate is not None:
        raise ValueError(f"validate must be 'm:1' or None, not {validate!r}")

    carried = [c for c in right.columns if c not in shared]
    names = {c: c + suffix_right if c in left.columns else c for c in carried}
    output = [*left.columns, *names.values()]
    if len(set(output)) != len(output):
        raise ValueError(f"join would repeat column names: {sorted({c for c in output if output.count(c) > 1})}")

    side = right.select(*[F.col(c).alias(f"__r_{c}") for c in right.columns])
    match = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"__r_{r}")) for k, r in zip(left_keys, right_keys)],
    )

    def shaped(joined: DataFrame, key_from_right: bool) -> DataFrame:
        def left_column(c):
            return F.col(f"__r_{c}").alias(c) if key_from_right and c in shared else F.col(c)

        return joined.select(
            *[left_column(c) for c in left.columns],
            *[F.col(f"__r_{c}").alias(name) for c, name in names.items()],
        )

    if how != "outer":
        return shaped(left.join(side, match, how), key_from_right=how == "right")
    matched = shaped(left.join(side, match, "left"), key_from_right=False)
    left_only_keys = left.select(*left_keys).distinct()
    alone = side.join(left_only_keys, match, "left_anti")
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema if f.name not in shared]
    return matched.unionByName(shaped(alone.select("*", *blank), key_from_right=True))


def check_unique(df: DataFrame, keys: Iterable[str]) -> None:
    """Raise :class:`JoinKeyError` if any key combination occurs twice."""
    repeated = repeated_keys(df, keys)
    example = repeated.first()
    if example is not None:
        raise JoinKeyError(f"keys {as_list(keys)} are not unique, e.g. {example.asDict()}")


def repeated_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Key combinations that occur more than once, with their number of rows."""
    return df.groupBy(*as_list(keys)).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def lookup(
    df: DataFrame, table: DataFrame, code: str, table_code: str, drop_code: bool = True
) -> DataFrame:
    """Translate a code through a lookup table (left join) and drop the code."""
    joined = join(df, table, left_on=code, right_on=table_code)
    extra = table_code + "_r" if table_code in df.columns and table_code != code else table_code
    if not drop_code:
        return joined if table_code == code else joined.drop(extra)
    return joined.drop(code, extra)


def keep_matching(df: DataFrame, keys_of: DataFrame, on: str | Iterable[str]) -> DataFrame:
    """Rows whose key occurs in the other frame."""
    return df.join(keys_of.select(*as_list(on)).distinct(), as_list(on), "left_semi")
