"""Elapsed time and time-zone handling.

Differences are taken between timestamps, which gives a day-time interval that
does not depend on the session time zone, and are floored towards minus
infinity. Calendar functions are avoided: ``datediff`` counts midnights and
``timestampdiff`` truncates towards zero.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 86_400_000_000


def micros_between(start: Column, end: Column) -> Column:
    """``end - start`` in whole microseconds (bigint), null if either is null."""
    seconds = (end - start).cast("interval second").cast("decimal(20,6)")
    return (seconds * 1_000_000).cast("bigint")


def _floor_units(micros: Column, unit: int) -> Column:
    # Taking the remainder off first keeps the division exact in a double.
    return ((micros - F.pmod(micros, F.lit(unit))) / F.lit(unit)).cast("bigint")


def hours_between(start: Column, end: Column) -> Column:
    """Whole hours from ``start`` to ``end``, floored."""
    return _floor_units(micros_between(start, end), MICROS_PER_HOUR)


def days_between(start: Column, end: Column) -> Column:
    """Whole days from ``start`` to ``end``, floored."""
    return _floor_units(micros_between(start, end), MICROS_PER_DAY)


def fractional_days(start: Column, end: Column) -> Column:
    """Elapsed days as a double."""
    return micros_between(start, end) / F.lit(float(MICROS_PER_DAY))


def to_utc_naive(col: Column) -> Column:
    """Zoned timestamp to zone-less UTC wall clock, whatever the session zone is."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), col.cast("timestamp_ntz"))


def drop_zone(col: Column) -> Column:
    """Forget the zone and keep the wall clock of the session zone."""
    return col.cast("timestamp_ntz")


# strptime directive -> Spark pattern letters (fixed values).
STRPTIME_TO_SPARK = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "MM",
    "%d": "dd",
    "%H": "HH",
    "%I": "hh",
    "%M": "mm",
    "%S": "ss",
    "%f": "SSSSSS",
    "%p": "a",
    "%b": "MMM",
    "%B": "MMMM",
    "%j": "DDD",
    "%z": "[XXX][XX]",
    "%%": "%",
}


# These take one or two digits where a separator ends them (fixed values).
ONE_OR_TWO = {"%m": "M", "%d": "d", "%H": "H", "%I": "h", "%M": "m", "%S": "s"}


def spark_pattern(fmt: str) -> str:
    """Translate a strptime format into a Spark datetime pattern.

    A number next to another one has its full width; one between separators may
    leave out its leading zero.
    """
    out, i = [], 0
    while i < len(fmt):
        if fmt[i] == "%":
            directive = fmt[i : i + 2]
            if directive not in STRPTIME_TO_SPARK:
                raise ValueError(f"unsupported datetime directive {directive!r} in {fmt!r}")
            alone = fmt[i + 2 : i + 3] != "%" and fmt[max(0, i - 2) : max(0, i - 1)] != "%"
            out.append(ONE_OR_TWO[directive] if alone and directive in ONE_OR_TWO else STRPTIME_TO_SPARK[directive])
            i += 2
        else:
            ch = fmt[i]
            out.append(f"'{ch}'" if ch.isalpha() else ch)
            i += 1
    return "".join(out)


def any_moment(col: Column) -> Column:
    """Text in one of the usual spellings as a zone-less timestamp; a stated zone is converted to UTC."""
    text = F.trim(col.cast("string"))
    zoned = text.rlike(r"\d[ ]?(Z|UTC|[+-]\d{1,2}(:?\d{2})?)$") & text.rlike(r"\d:\d{2}")
    return F.when(zoned, to_utc_naive(text.try_cast("timestamp"))).otherwise(text.try_cast("timestamp_ntz"))


def parse_datetime(col: Column, fmt: str | None = None, drop_tz: bool = False) -> Column:
    """Text to timestamp; text that does not fit becomes null.

    A format with a zone gives an instant, which ``drop_tz`` turns into UTC wall
    clock; a format without one gives a zone-less timestamp. Without a format the
    usual spellings are read and a stated zone is converted to UTC wall clock.
    """
    if fmt is None:
        return any_moment(col)
    parsed = F.try_to_timestamp(col.cast("string"), F.lit(spark_pattern(fmt)))
    if "%z" not in fmt:
        return parsed.cast("timestamp_ntz")
    return to_utc_naive(parsed) if drop_tz else parsed
