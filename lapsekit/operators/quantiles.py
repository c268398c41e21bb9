"""Exact quantiles with linear interpolation, at any size.

Spark's ``percentile`` is exact but keeps every distinct value of the column in
one task. Here a sketch first brackets each wanted quantile by two values; its
error is bounded, so the brackets hold all but a sliver of the rows outside.
Then one aggregate counts the rows between brackets as single groups and the
values inside brackets one by one. The shuffle carries only those groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Sketch size: each bracket holds about 2 * _MARGIN / accuracy of the rows.
ACCURACY = 10_000
# A bracket with more rows is bracketed again, by a sketch of the rows inside it.
BRACKET_ROWS = 1_000_000
_MARGIN = 3

Bracket = tuple[float, float]


def _clean(c: str) -> Column:
    value = F.col(c).cast("double")
    return F.when(~F.isnan(value), value)


def _sketched(df: DataFrame, wanted: list[tuple[str, float, Bracket]], accuracy: int) -> list[tuple[int, int, list[float] | None]]:
    """For each (column, share of the rows inside, bracket): rows below it, rows inside, and the values around the share."""
    margin, measures = _MARGIN / accuracy, []
    for i, (c, share, (low, high)) in enumerate(wanted):
        value = _clean(c)
        inside = F.when((value >= low) & (value <= high), value)
        around = [min(1.0, max(0.0, share + side * margin)) for side in (-1, 1)]
        measures += [
            F.count_if(value < low).alias(f"below{i}"), F.count(inside).alias(f"n{i}"), F.percentile_approx(inside, around, accuracy).alias(f"b{i}"),
        ]
    row = df.agg(*measures).first()
    return [(row[f"below{i}"], row[f"n{i}"], row[f"b{i}"]) for i in range(len(wanted))]


def _brackets(
    df: DataFrame, cols: Sequence[str], probabilities: Sequence[float], accuracy: int, most: int
) -> dict[str, list[Bracket]]:
    """Disjoint, ascending value ranges that hold the wanted ranks; a few numbers per quantile are fetched.

    The first sketch covers the whole columns. A bracket that still holds more than
    ``most`` rows is cut again by a sketch of its own rows, so the sketches keep their
    size however many rows there are.
    """
    margin = _MARGIN / accuracy
    around = [min(1.0, max(0.0, p + side * margin)) for p in sorted(probabilities) for side in (-1, 1)]
    row = df.agg(
        *[F.percentile_approx(_clean(c), around, accuracy).alias(f"b{i}") for i, c in enumerate(cols)],
        *[F.count(_clean(c)).alias(f"n{i}") for i, c in enumerate(cols)],
    ).first()
    single: dict[tuple[str, float], Bracket] = {}
    total = {c: row[f"n{i}"] for i, c in enumerate(cols)}
    for i, c in enumerate(cols):
        if row[f"b{i}"] is not None:
            single |= {(c, p): pair for p, pair in zip(sorted(probabilities), zip(row[f"b{i}"][::2], row[f"b{i}"][1::2]))}
    # An expected share of the rows tells whether a bracket can be too full; equal values cannot be cut.
    open_ = [k for k, (low, high) in single.items() if 2 * margin * total[k[0]] > most and low < high]
    while open_:
        counts = _sketched(df, [(c, 0.5, single[c, p]) for c, p in open_], 2)
        full = [(k, below, n) for k, (below, n, _) in zip(open_, counts) if n > most]
        if not full:
            break
        shares = [min(1.0, max(0.0, (k[1] * (total[k[0]] - 1) - below) / max(n - 1, 1))) for k, below, n in full]
        found = _sketched(df, [(k[0], share, single[k]) for (k, _, _), share in zip(full, shares)], accuracy)
        open_ = []
        for (k, _, _), (_, _, pair) in zip(full, found):
            if (pair[0], pair[1]) != single[k] and pair[0] < pair[1]:
                open_.append(k)
            single[k] = (pair[0], pair[1])
    brackets: dict[str, list[Bracket]] = {}
    for c in cols:
        merged: list[Bracket] = []
        for low, high in sorted(pair for (name, _), pair in single.items() if name == c):
            if merged and low <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
            else:
                merged.append((low, high))
        if merged:
            brackets[c] = merged
    return brackets


def _segment(value: Column, brackets: Sequence[Bracket]) -> Column:
    """0, 2, 4, ... between brackets and 1, 3, 5, ... inside them, in value order."""
    place = F.lit(0)
    for low, high in brackets:
        place = place + (value >= low).cast("int") + (value > high).cast("int")
    return place


def _at_rank(rank: Column) -> Column:
    """The value at a 0-based rank, from groups of equal or bracketed-out values."""
    missed = F.raise_error(F.lit("quantile outside its bracket; raise the accuracy")).cast("double")
    value = (
        F.when(F.col("lo") == F.col("hi"), F.col("lo"))
        .when(rank == F.col("start"), F.col("lo"))
        .when(rank == F.col("end") - 1, F.col("hi"))
        .otherwise(missed)
    )
    return F.max(F.when((rank >= F.col("start")) & (rank < F.col("end")), value))


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probabilities: Sequence[float], accuracy: int = ACCURACY, most: int = BRACKET_ROWS
) -> DataFrame:
    """One row per column: ``name`` and ``quantiles``, an array in the order asked for.

    Nulls and NaN are skipped; a column without values has no row. The bracketing
    sketch runs at once, the rest when the result is used.
    """
    brackets = _brackets(df, cols, probabilities, accuracy, most)
    if not brackets:
        return df.sparkSession.createDataFrame([], "name string, quantiles array<double>")
    # Each column is cleaned once, so the bracket tests stay small enough to be compiled.
    cleaned = df.select(*[_clean(c).alias(f"v{i}") for i, c in enumerate(brackets)])
    rows = [
        F.struct(F.lit(c).alias("name"), _segment(F.col(f"v{i}"), b).alias("segment"), F.col(f"v{i}").alias("value"))
        for i, (c, b) in enumerate(brackets.items())
    ]
    inside = F.when(F.col("segment") % 2 == 1, F.col("value"))
    groups = (
        cleaned.select(F.explode(F.array(*rows)).alias("r"))
        .select("r.*")
        .filter(F.col("value").isNotNull())
        .groupBy("name", "segment", inside.alias("at"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    )
    by_name = Window.partitionBy("name")
    before = (Window.unboundedPreceding, -1)
    # One row per column and segment.
    offsets = groups.groupBy("name", "segment").agg(F.sum("n").alias("n")).select(
        F.col("name").alias("o_name"),
        F.col("segment").alias("o_segment"),
        F.coalesce(F.sum("n").over(by_name.orderBy("segment").rowsBetween(*before)), F.lit(0)).alias("offset"),
        F.sum("n").over(by_name).alias("total"),
    )
    placed = groups.join(
        F.broadcast(offsets), (F.col("name") == F.col("o_name")) & (F.col("segment") == F.col("o_segment"))
    )
    in_segment = Window.partitionBy("name", "segment").orderBy("at").rowsBetween(*before)
    start = F.col("offset") + F.coalesce(F.sum("n").over(in_segment), F.lit(0))
    ranked = placed.select("name", "lo", "hi", "total", start.alias("start"), (start + F.col("n")).alias("end"))

    picks, values = [], []
    for i, p in enumerate(probabilities):
        position = F.lit(float(p)) * (F.col("total") - 1)
        picks += [_at_rank(F.floor(position)).alias(f"lo{i}"), _at_rank(F.ceil(position)).alias(f"hi{i}")]
        low, high = F.col(f"lo{i}"), F.col(f"hi{i}")
        share = position - F.floor(position)
        values.append(F.when(low == high, low).otherwise(low + (high - low) * share))
    ends = ranked.groupBy("name").agg(F.max("total").alias("total"), *picks)
    return ends.select("name", F.array(*values).alias("quantiles"))


def quantile_column(df: DataFrame, col: str, probability: float) -> Column:
    """One quantile as a scalar usable in expressions on any frame."""
    found = exact_quantiles(df, [col], [probability])
    return found.agg(F.max(F.get("quantiles", F.lit(0)))).scalar()


def soft_bounds(
    df: DataFrame, cols: Sequence[str], low: float = 0.01, high: float = 0.99, pad: float = 0.1
) -> DataFrame:
    """Quantile bounds widened by ``pad`` of their span: ``name``, ``low``, ``high``.

    An infinite span is treated as zero, so the bounds are the quantiles themselves.
    """
    found = exact_quantiles(df, cols, [low, high])
    lo, hi = F.get("quantiles", F.lit(0)), F.get("quantiles", F.lit(1))
    finite = F.abs(hi - lo) < float("inf")
    span = F.when(finite, hi - lo).otherwise(0.0)
    return found.select("name", (lo - pad * span).alias("low"), (hi + pad * span).alias("high"))
