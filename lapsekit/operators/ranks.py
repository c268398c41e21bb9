"""Running totals over a total order without a one-task window.

A window without a partition key sends every row to one task. Here the order is
first cut into ranges; each range is summed, the (few) range totals are
accumulated, and the running total inside a range starts from the total of the
ranges before it. The result is exact wherever the cuts fall.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from lapsekit.plans.sizing import SINGLE_TASK_BYTES, fits

RANGES = 512
_STEP = 23


def cut_points(df: DataFrame, group: Sequence[str], value: str, ranges: int = RANGES) -> DataFrame:
    """Approximate, evenly spaced cut points of ``value`` per group, as a literal table.

    The sketches are mergeable and of fixed size. They run at once, because a
    sketch depends on the order in which its parts merge: evaluated twice in one
    plan it could cut differently. ``group`` must have few distinct values
    (columns, classes); one row of ``ranges - 1`` numbers per group reaches the driver.
    """
    probabilities = [i / ranges for i in range(1, ranges)]
    sketch = F.percentile_approx(F.col(value), probabilities, 20 * ranges)
    bounds = df.groupBy(*[F.col(g).alias(f"__b_{g}") for g in group]).agg(
        F.array_distinct(sketch).alias("__bounds")
    )
    # Every _STEP-th cut, so that a lookup compares about 2 * sqrt(ranges) numbers.
    coarse = F.filter("__bounds", lambda b, i: i % _STEP == _STEP - 1)
    bounds = bounds.withColumn("__coarse", coarse)
    return df.sparkSession.createDataFrame(bounds.toArrow(), schema=bounds.schema)


def with_range(df: DataFrame, group: Sequence[str], value: str, bounds: DataFrame) -> DataFrame:
    """Add ``__range``: how many cut points of its group lie below the value."""
    only = bounds.limit(2).collect()
    if len(only) == 1:
        # A single group needs no join.
        kind = bounds.schema["__bounds"].dataType
        joined = df.withColumns({c: F.lit(only[0][c]).cast(kind) for c in ("__bounds", "__coarse")})
    else:
        match = F.lit(True)
        for g in group:
            match = match & F.col(g).eqNullSafe(F.col(f"__b_{g}"))
        joined = df.join(F.broadcast(bounds), match)
    passed = F.size(F.filter("__coarse", lambda b: b < F.col(value))) * _STEP
    joined = joined.withColumn("__passed", passed)
    nearby = F.slice("__bounds", F.col("__passed") + 1, F.lit(_STEP))
    place = F.col("__passed") + F.size(F.filter(nearby, lambda b: b < F.col(value)))
    return joined.select(*[F.col(c) for c in df.columns], place.alias("__range"))


def running_before(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    amounts: Sequence[str],
    ranges: int = RANGES,
    single_task_bytes: int = SINGLE_TASK_BYTES,
) -> DataFrame:
    """Add ``<amount>_before``: the sum of the amount over strictly smaller values.

    ``df`` holds one row per (group, value), such as the result of a grouped count.
    A frame estimated to fit one task is accumulated by a plain window.
    """
    if fits(df, single_task_bytes):
        smaller = Window.partitionBy(*group).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns({f"{a}_before": F.coalesce(F.sum(a).over(smaller), F.lit(0)) for a in amounts})
    ranged = with_range(df, group, value, cut_points(df, group, value, ranges))
    per_range = ranged.groupBy(*group, "__range").agg(*[F.sum(a).alias(f"__{a}") for a in amounts])
    earlier = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        *[F.col(g).alias(f"__g_{g}") for g in group],
        F.col("__range").alias("__offset_range"),
        *[F.coalesce(F.sum(f"__{a}").over(earlier), F.lit(0)).alias(f"__{a}_offset") for a in amounts],
    )
    match = F.col("__range") == F.col("__offset_range")
    for g in group:
        match = match & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    inside = Window.partitionBy(*group, "__range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    # groups x ranges rows: the bound on the broadcast table.
    return ranged.join(F.broadcast(offsets), match).select(
        *[F.col(c) for c in df.columns],
        *[
            (F.col(f"__{a}_offset") + F.coalesce(F.sum(a).over(inside), F.lit(0))).alias(f"{a}_before")
            for a in amounts
        ],
    )


def _common_prefix(df: DataFrame, key: str) -> int:
    """Bytes that all values begin with; two values reach the driver."""
    low, high = df.agg(F.min(F.encode(key, "UTF-8")), F.max(F.encode(key, "UTF-8"))).first()
    if low is None:
        return 0
    same = [a == b for a, b in zip(low, high)]
    return same.index(False) if False in same else len(same)


def text_running_before(df: DataFrame, key: str, amounts: Sequence[str], ranges: int = RANGES, one_task: bool = False) -> DataFrame:
    """Add ``<amount>_before``: the sum of the amount over the rows whose text ``key`` comes earlier.

    ``df`` holds one row per present value of ``key``, of which there may be very many. The seven bytes behind the
    prefix that all values share stand for a value where the order is cut into ranges; the order
    itself is that of the whole texts. ``one_task`` accumulates a small table by a plain window.
    """
    before = (Window.unboundedPreceding, -1)
    if one_task:
        earlier = Window.partitionBy(F.lit(0)).orderBy(key).rowsBetween(*before)
        return df.withColumns({f"{a}_before": F.coalesce(F.sum(a).over(earlier), F.lit(0)) for a in amounts})
    bytes_ = F.substring(F.encode(key, "UTF-8"), _common_prefix(df, key) + 1, 7)
    coded = df.withColumn("__code", F.conv(F.rpad(F.hex(bytes_), 14, "0"), 16, 10).cast("long"))
    ranged = with_range(coded, [], "__code", cut_points(coded, [], "__code", ranges))
    per_range = ranged.groupBy("__range").agg(*[F.sum(a).alias(f"__{a}") for a in amounts])
    # One row per range.
    earlier = Window.partitionBy(F.lit(0)).orderBy("__range").rowsBetween(*before)
    offsets = per_range.select(
        F.col("__range").alias("__offset_range"), *[F.coalesce(F.sum(f"__{a}").over(earlier), F.lit(0)).alias(f"__{a}_offset") for a in amounts]
    )
    inside = Window.partitionBy("__range").orderBy(key).rowsBetween(*before)
    return ranged.join(F.broadcast(offsets), F.col("__range") == F.col("__offset_range")).select(
        *df.columns, *[(F.col(f"__{a}_offset") + F.coalesce(F.sum(a).over(inside), F.lit(0))).alias(f"{a}_before") for a in amounts]
    )
