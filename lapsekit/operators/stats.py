"""Whole-column statistics, one row per column, one scan per table."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lapsekit.functions.timing import fractional_days
from lapsekit.operators.columns import as_list, columns_of_type, value_of
from lapsekit.operators.quantiles import exact_quantiles


def unpack(row: DataFrame, entries: list[Column]) -> DataFrame:
    """Turn a one-row aggregate into one row per struct."""
    return row.select(F.explode(F.array(*entries)).alias("__e")).select("__e.*")


def null_counts(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """``name``, ``n_null`` for every column; NaN counts as null."""
    names = as_list(cols) or df.columns
    row = df.agg(*[F.count_if(value_of(df, c).isNull()).alias(c) for c in names])
    return unpack(row, [F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").alias("n_null")) for c in names])


def describe(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per numeric column; NaN is skipped like null."""
    names = as_list(cols) or columns_of_type(df, "numeric")
    measures = {
        "n": lambda c: F.count(c),
        "mean": lambda c: F.avg(c),
        "std": lambda c: F.stddev_samp(c),
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    }
    row = df.agg(*[f(value_of(df, c)).alias(f"{m}_{c}") for c in names for m, f in measures.items()])
    basics = unpack(
        row,
        [F.struct(F.lit(c).alias("name"), *[F.col(f"`{m}_{c}`").alias(m) for m in measures]) for c in names],
    )
    quartiles = exact_quantiles(df, names, [0.25, 0.5, 0.75]).select(
        "name", *[F.get("quantiles", F.lit(i)).alias(q) for i, q in enumerate(("q25", "q50", "q75"))]
    )
    # One row per column on both sides.
    return basics.join(F.broadcast(quartiles), "name", "left").select(
        "name", "n", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def datetime_summary(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """``name``, ``earliest``, ``latest`` and the range in days, sorted by name."""
    names = sorted(as_list(cols) or columns_of_type(df, "datetime"))
    row = df.agg(*[f(c).alias(f"{m}_{c}") for c in names for m, f in (("lo", F.min), ("hi", F.max))])
    entries = []
    for c in names:
        lo, hi = F.col(f"`lo_{c}`").cast("timestamp_ntz"), F.col(f"`hi_{c}`").cast("timestamp_ntz")
        entries.append(
            F.struct(
                F.lit(c).alias("name"),
                lo.alias("earliest"),
                hi.alias("latest"),
                fractional_days(lo, hi).alias("range_days"),
            )
        )
    return unpack(row, entries)


def correlation_pairs(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of columns, rows with a null in the pair skipped.

    The upper triangle in one aggregate: ``column_a``, ``column_b``, ``corr``.
    """
    names = as_list(cols) or columns_of_type(df, "numeric")
    pairs = list(combinations(names, 2))

    def corr(a: str, b: str) -> Column:
        """Null, not an error, where a column does not vary."""
        x, y = value_of(df, a), value_of(df, b)
        spread = F.var_pop(F.when(y.isNotNull(), x)) * F.var_pop(F.when(x.isNotNull(), y))
        return F.try_divide(F.covar_pop(x, y), F.sqrt(spread))

    row = df.agg(*[corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return unpack(
        row,
        [
            F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"c{i}").alias("corr"))
            for i, (a, b) in enumerate(pairs)
        ],
    )


def _gram(names: list[str], left: tuple[int, int], right: tuple[int, int], means: np.ndarray):
    """Sums over the rows where both columns of a pair are present, for the pairs of two tiles of columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = (left[1] - left[0], right[1] - right[0])
        n, sx, sy, sxx, syy, sxy = (np.zeros(shape) for _ in range(6))

        def part(batch: pa.RecordBatch, tile: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
            columns = [batch.column(names[i]).to_numpy(zero_copy_only=False).astype(float) - means[i] for i in range(*tile)]
            values = np.column_stack(columns)
            held = ~np.isnan(values)
            return np.where(held, values, 0.0), held.astype(float)

        for batch in batches:
            if not batch.num_rows:
                continue
            (x, mx), (y, my) = part(batch, left), part(batch, right)
            n += mx.T @ my
            sx += x.T @ my
            sy += mx.T @ y
            sxx += (x * x).T @ my
            syy += mx.T @ (y * y)
            sxy += x.T @ y
        a, b = np.nonzero(n)
        keep = a + left[0] < b + right[0]
        a, b = a[keep], b[keep]
        columns = [pa.array(a + left[0], pa.int32()), pa.array(b + right[0], pa.int32()), *[pa.array(m[a, b]) for m in (n, sx, sy, sxx, syy, sxy)]]
        whole = pa.RecordBatch.from_arrays(columns, names=["a", "b", "n", "sx", "sy", "sxx", "syy", "sxy"])
        for at in range(0, len(a), 1 << 16):
            yield whole.slice(at, 1 << 16)

    return run


def correlation_tiles(df: DataFrame, cols: Iterable[str] | None = None, tile: int = 512) -> DataFrame:
    """Like :func:`correlation_pairs` for very many columns: ``column_a``, ``column_b``, ``corr``.

    Columns are cut into tiles. For each two tiles a task multiplies its batches as matrices, so a scan reads
    the columns of two tiles and holds six matrices of ``tile`` squared numbers, and one row per pair and task is
    summed. Values are taken from their column's mean first, as sums of squares of large numbers
    lose their digits. Nulls and NaN leave out the row for that pair. The correlation is null
    where a pair has no two rows in common or one side does not vary.
    """
    names = as_list(cols) or columns_of_type(df, "numeric")
    values = df.select(*[value_of(df, c).cast("double").alias(c) for c in names])
    # One number per column.
    found = [row for at in range(0, len(names), tile) for row in values.agg(*[F.avg(f"`{c}`") for c in names[at : at + tile]]).first()]
    means = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in found])
    tiles = [(at, min(at + tile, len(names))) for at in range(0, len(names), tile)]
    schema = "a int, b int, n double, sx double, sy double, sxx double, syy double, sxy double"
    parts = None
    for left, right in combinations_with_replacement(tiles, 2):
        needed = dict.fromkeys([*names[slice(*left)], *names[slice(*right)]])
        part = values.select(*[F.col(f"`{c}`") for c in needed]).mapInArrow(_gram(names, left, right, means), schema)
        parts = part if parts is None else parts.unionByName(part)
    sums = parts.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    spread = (F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")) * (F.col("syy") - F.col("sy") * F.col("sy") / F.col("n"))
    # What rounding leaves of a column that does not vary is not a spread.
    varies = spread > 1e-24 * F.col("sxx") * F.col("syy")
    corr = F.when(varies, (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")) / F.sqrt(spread))
    # A column pairs with each later one, whether they have rows in common or not.
    listed = df.sparkSession.range(max(len(names) - 1, 0)).select(
        F.col("id").cast("int").alias("a"), F.explode(F.sequence(F.col("id").cast("int") + 1, F.lit(len(names) - 1))).alias("b")
    )
    labels = df.sparkSession.createDataFrame(list(enumerate(names)), "i int, column string")
    result = listed.join(sums.withColumn("corr", corr), ["a", "b"], "left")
    for side in ("a", "b"):
        result = result.join(labels.toDF(side, f"column_{side}"), side)
    return result.select("column_a", "column_b", "corr")


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bin counts between the column's minimum and maximum.

    ``bin`` (from 0), ``low``, ``high``, ``n``; the last bin includes the maximum
    and empty bins are listed.
    """
    value = value_of(df, col).cast("double")
    edges = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("e"))
    placed = df.filter(value.isNotNull()).select(value.alias("v"), edges.scalar().alias("e"))
    width = (F.col("e.hi") - F.col("e.lo")) / bins
    position = F.when(width == 0, 0).otherwise(F.floor(F.try_divide(F.col("v") - F.col("e.lo"), width)))
    counts = placed.groupBy(F.least(position, F.lit(bins - 1)).cast("int").alias("b")).agg(
        F.count(F.lit(1)).alias("n")
    )
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"), edges.scalar().alias("e"))
    return frame.join(counts, F.col("bin") == F.col("b"), "left").select(
        "bin",
        (F.col("e.lo") + F.col("bin") * width).alias("low"),
        (F.col("e.lo") + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
