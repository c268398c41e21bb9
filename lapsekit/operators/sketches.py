"""Profiles that can be merged: a new day's rows cost a scan of that day only.

:func:`sketch_profile` keeps, for each column, counts, extremes, the values of short
category lists and two sketches: KLL for quantiles (its rank error is ``RANK_ERROR``) and HLL for the number of values. Sketched profiles of disjoint sets of rows
are unioned and merged by :func:`merge_profiles`, in any grouping and order, as often as wanted;
:func:`profile_from_sketches` turns one into the columns of :func:`lapsekit.operators.profiling.profile`.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from lapsekit.operators.columns import as_list, is_numeric, value_of
from lapsekit.operators.profiling import MAX_CATEGORIES, logical_type
from lapsekit.operators.stats import unpack

# Entries of a quantile sketch, and bits of a distinct sketch: fixed sizes, whatever the table's.
KLL_SIZE, HLL_BITS = 1000, 12
#: Share of ranks by which a quantile of a sketch of ``KLL_SIZE`` may be off, with 99 % confidence.
RANK_ERROR = 0.0028
_NUMERIC = "dtype in ('integer', 'floating', 'decimal')"


def _short_lists(df: DataFrame, names: list[str]) -> list[str]:
    """Columns whose values may be listed, by an estimate far above the limit."""
    if not names:
        return []
    row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in names]).first()
    return [c for c in names if row[c] <= 2 * MAX_CATEGORIES]


def sketch_profile(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """One row per column: ``name, dtype, rows, present, lowest, highest, earliest, latest, values, quantiles, distinct``.

    ``quantiles`` and ``distinct`` are sketches. ``values`` lists a column that is neither numeric nor
    has more than 50 values and is null otherwise. NaN counts as null. An empty table gives rows
    with empty sketches, which merging leaves without effect.
    """
    df = df.select(*as_list(cols)) if cols else df
    kinds = {f.name: logical_type(f) for f in df.schema}
    listed = set(_short_lists(df, [c for c, k in kinds.items() if k in ("boolean", "date", "datetime64", "string")]))
    measures: list[Column] = [F.count(F.lit(1)).alias("rows")]
    entries: list[Column] = []
    for i, field in enumerate(df.schema):
        c, value = field.name, value_of(df, field.name)
        numeric, moment = is_numeric(field), kinds[c] in ("date", "datetime64")
        kept = {"n": F.count(value)}
        if kinds[c] != "mixed":
            kept["d"] = F.hll_sketch_agg(value.cast("string"), HLL_BITS)
        if numeric:
            kept |= {"k": F.kll_sketch_agg_double(value.cast("double"), F.lit(KLL_SIZE)), "lo": F.min(value).cast("double"), "hi": F.max(value).cast("double")}
        if moment:
            kept |= {"from": F.min(value).cast("timestamp_ntz"), "to": F.max(value).cast("timestamp_ntz")}
        if c in listed:
            kept["set"] = F.collect_set(value.cast("string"))
        measures += [v.alias(f"{k}_{i}") for k, v in kept.items()]

        def got(key: str, kind: str, kept: Mapping[str, Column] = kept, i: int = i) -> Column:
            return F.col(f"{key}_{i}") if key in kept else F.lit(None).cast(kind)

        values = got("set", "array<string>")
        entries.append(
            F.struct(
                F.lit(c).alias("name"), F.lit(kinds[c]).alias("dtype"), F.col("rows"), got("n", "long").alias("present"),
                got("lo", "double").alias("lowest"), got("hi", "double").alias("highest"),
                got("from", "timestamp_ntz").alias("earliest"), got("to", "timestamp_ntz").alias("latest"),
                F.when(F.size(values) <= MAX_CATEGORIES, F.array_sort(values)).alias("values"),
                got("k", "binary").alias("quantiles"), got("d", "binary").alias("distinct"),
            )
        )
    return unpack(df.agg(*measures), entries)


def merge_profiles(*parts: DataFrame) -> DataFrame:
    """Sketched profiles of disjoint rows as one; a single frame may itself hold several rows per column.

    Columns are matched by name; a column whose type differs between parts is ``mixed``, and
    one missing in a part counts as null there. Lists stay lists while their union has at most 50 values.
    """
    if not parts:
        raise ValueError("no profiles given")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    kind = F.when(F.min("dtype") == F.max("dtype"), F.min("dtype")).otherwise("mixed")
    # A part without rows has an empty list, which is no reason to give lists up.
    listed = F.count("values") == F.count(F.lit(1))
    values = F.array_sort(F.array_distinct(F.flatten(F.collect_list("values"))))
    return every.groupBy("name").agg(
        kind.alias("dtype"), F.sum("rows").alias("rows"), F.sum("present").alias("present"),
        F.min("lowest").alias("lowest"), F.max("highest").alias("highest"),
        F.min("earliest").alias("earliest"), F.max("latest").alias("latest"),
        F.when(listed & (F.size(values) <= MAX_CATEGORIES), values).alias("values"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"), F.hll_union_agg("distinct").alias("distinct"),
    )


def _sketch_quantile(probability: float) -> Column:
    usable = F.when(F.kll_sketch_get_n_double("quantiles") > 0, F.col("quantiles"))
    return F.kll_sketch_get_quantile_double(usable, F.lit(probability))


def profile_from_sketches(sketched: DataFrame, low: float = 0.01, high: float = 0.99, pad: float = 0.1) -> DataFrame:
    """A sketched profile in the columns of an exact one, and ``n_values``, the estimated number of values.

    Counts, null rates, extremes and lists are exact; ``low`` and ``high`` are the sketch's quantiles,
    widened by ``pad`` of their span. A table profile made so is a suite like any other.
    """
    lo, hi = _sketch_quantile(low), _sketch_quantile(high)
    span = F.when(F.abs(hi - lo) < float("inf"), hi - lo).otherwise(0.0)
    return sketched.select(
        "name", F.when(F.col("present") == 0, "empty").otherwise(F.col("dtype")).alias("dtype"), F.col("rows").alias("row_count"),
        F.try_divide((F.col("rows") - F.col("present")).cast("double"), F.col("rows")).alias("null_rate"),
        F.when(F.expr(_NUMERIC), lo - pad * span).alias("low"), F.when(F.expr(_NUMERIC), hi + pad * span).alias("high"),
        F.col("values").alias("categories"), "earliest", "latest", F.hll_sketch_estimate("distinct").alias("n_values"),
    )


def sketch_many(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Sketched profiles of several tables, with the table's name in ``dataset``; store it and merge it by ``dataset``."""
    result = None
    for dataset, df in tables.items():
        part = sketch_profile(df).select(F.lit(dataset).alias("dataset"), "*")
        result = part if result is None else result.unionByName(part)
    if result is None:
        raise ValueError("no tables given")
    return result


def merge_many(*parts: DataFrame) -> DataFrame:
    """Sketched profiles of several tables and days, merged per ``dataset`` and column."""
    named = [p.withColumn("name", F.concat_ws("\x1f", "dataset", "name")).drop("dataset") for p in parts]
    both = F.split("name", "\x1f")
    return merge_profiles(*named).select(both[0].alias("dataset"), both[1].alias("name"), *[c for c in named[0].columns if c != "name"])


def quantile_rank_errors(df: DataFrame, sketched: DataFrame, probabilities: Iterable[float]) -> DataFrame:
    """``name, probability, value, error``: how far the true rank share of a sketched quantile is from the one asked for.

    Costs one scan; meant for auditing stored profiles. Where equal values span the asked rank the error is 0.
    """
    wanted = [float(p) for p in probabilities]
    # One row per numeric column.
    picked = sketched.where(F.expr(_NUMERIC) & (F.kll_sketch_get_n_double("quantiles") > 0)).select("name", F.array(*[_sketch_quantile(p) for p in wanted]).alias("q")).collect()
    measures, entries = [], []
    for i, (c, quantiles) in enumerate(picked):
        value = value_of(df, c).cast("double")
        measures.append(F.count(value).alias(f"n{i}"))
        for j, (p, q) in enumerate(zip(wanted, quantiles)):
            measures += [F.count_if(value < q).alias(f"b{i}_{j}"), F.count_if(value <= q).alias(f"e{i}_{j}")]
            below, until = [F.try_divide(F.col(f"{k}{i}_{j}"), F.col(f"n{i}")) for k in ("b", "e")]
            error = F.greatest(below - p, p - until, F.lit(0.0))
            entries.append(F.struct(F.lit(c).alias("name"), F.lit(p).alias("probability"), F.lit(q).cast("double").alias("value"), error.alias("error")))
    if not entries:
        return df.sparkSession.createDataFrame([], "name string, probability double, value double, error double")
    return unpack(df.agg(*measures), entries)
