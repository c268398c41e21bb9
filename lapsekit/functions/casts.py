"""Casts from text (or any type) to a declared type.

Each function returns the cast value with null where the input does not fit, so
a report or a strict check can compare nulls before and after.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Accepted spellings after trimming and lower-casing (fixed values).
TRUE_WORDS = ["true", "1", "yes"]
FALSE_WORDS = ["false", "0", "no"]


def to_string(col: Column) -> Column:
    return col.cast("string")


def number_to_float(col: Column) -> Column:
    """A numeric or boolean column as a double; NaN is null."""
    number = col.cast("double")
    return F.when(~F.isnan(number), number)


def number_to_int(col: Column, whole_type: bool, truncate: bool = False) -> Column:
    """A numeric column as a whole number; a fraction is null unless ``truncate``."""
    if whole_type:
        return col.cast("bigint")
    number = number_to_float(col)
    return (number if truncate else F.when(number == F.floor(number), number)).try_cast("bigint")


def to_float(col: Column) -> Column:
    """Number or null. Java's ``1d``/``1f`` spellings are not numbers here, and NaN is null."""
    text = col.cast("string")
    number = F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text.try_cast("double"))
    return F.when(~F.isnan(number), number)


def to_int(col: Column, truncate: bool = False) -> Column:
    """Whole number or null; a fraction is null unless ``truncate``.

    The direct bigint cast comes first because a double holds only 53 bits.
    """
    number = to_float(col)
    whole = number if truncate else F.when(number == F.floor(number), number)
    return F.coalesce(col.cast("string").try_cast("bigint"), whole.try_cast("bigint"))


def has_fraction(col: Column) -> Column:
    """True where the value is a number that is not whole."""
    number = to_float(col)
    return F.coalesce(number != F.floor(number), F.lit(False))


def to_bool(col: Column) -> Column:
    word = F.lower(F.trim(col.cast("string")))
    return F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False)


def to_category(col: Column, categories: Sequence[str] | None = None) -> Column:
    """Text restricted to ``categories``; anything else is null."""
    text = col.cast("string")
    return F.when(text.isin(list(categories)), text) if categories else text


def category_rank(col: Column, categories: Sequence[str]) -> Column:
    """0-based position of an ordered category, null when absent."""
    place = F.array_position(F.array(*[F.lit(c) for c in categories]), col)
    return F.when(place > 0, place - 1).cast("int")
