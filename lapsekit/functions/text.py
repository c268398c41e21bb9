"""Text normalisation."""

from __future__ import annotations

import unicodedata
from functools import cache

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, functions as F, types as T

# (?U) makes \s cover Unicode spaces such as the no-break space; the four
# separator controls are whitespace in Python but not in Java's class.
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def snake_lower(col: Column) -> Column:
    """Lower-case, with every run of whitespace turned into one underscore."""
    return F.regexp_replace(F.lower(col.cast("string")), WHITESPACE_RUN, "_")


@cache
def _marks() -> str:
    """A pattern of all characters with a combining class, as ranges."""
    marks = [c for c in range(0x110000) if unicodedata.combining(chr(c))]
    starts = [c for i, c in enumerate(marks) if not i or marks[i - 1] != c - 1]
    ends = [c for i, c in enumerate(marks) if i + 1 == len(marks) or marks[i + 1] != c + 1]
    return "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in zip(starts, ends)) + "]+"


@F.arrow_udf(T.StringType())
def _without_marks(values: pa.Array) -> pa.Array:
    decomposed = pa.compute.utf8_normalize(values, form="NFKD")
    return pa.compute.replace_substring_regex(decomposed, pattern=_marks(), replacement="")


def strip_accents(col: Column) -> Column:
    """Decompose (NFKD) and drop combining marks.

    Spark has no normalisation function, so this is an Arrow UDF. Plain ASCII
    text is unchanged by it and is passed as null, so only the remaining values
    are copied to Python.
    """
    accented = F.when(col.rlike(r"[^\x00-\x7f]"), col)
    return F.coalesce(_without_marks(accented), col)


def prefix(col: Column, length: int) -> Column:
    """The first ``length`` characters."""
    return F.substring(col, 1, length)
