"""Checking a table against its profile.

All data checks of a table are one aggregate; the outcome is a findings frame
with one row per check: ``name``, ``check``, ``observed``, ``threshold``,
``passed``, ``detail``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lapsekit.functions.timing import any_moment, to_utc_naive
from lapsekit.operators.columns import as_list, is_datetime, is_numeric, value_of
from lapsekit.operators.profiling import logical_type

# Tolerances used when nothing else is given (fixed values).
DEFAULT_THRESHOLDS = {"null_delta_pp": 5.0, "new_cat_ratio": 0.02, "oob_ratio": 0.01}
FINDING_TYPE = (
    "struct<name: string, check: string, observed: double, threshold: double, passed: boolean, detail: string>"
)


class ValidationError(ValueError):
    """A table does not match its profile."""


def resolve_threshold(
    key: str, column: str, dataset: Mapping[str, Any] | None, defaults: Mapping[str, Any] | None
) -> float:
    """Column override, then data-set threshold, then default, then built-in."""
    dataset = dataset or {}
    for source in (
        (dataset.get("columns") or {}).get(column, {}),
        dataset.get("thresholds") or {},
        defaults or {},
        DEFAULT_THRESHOLDS,
    ):
        if key in source:
            return float(source[key])
    raise KeyError(key)


def _finding(name: str, check: str, observed: Column, threshold: float, detail: Column, passed: Column | None = None):
    observed = observed.cast("double")
    verdict = F.coalesce(observed <= threshold, F.lit(True)) if passed is None else passed
    return F.struct(
        F.lit(name).alias("name"),
        F.lit(check).alias("check"),
        observed.alias("observed"),
        F.lit(float(threshold)).alias("threshold"),
        verdict.alias("passed"),
        detail.alias("detail"),
    )


def _novel(col: Column, categories: list[str]) -> Column:
    text = col.cast("string")
    return text.isNotNull() & ~text.isin(categories) if categories else text.isNotNull()


def _out_of_bounds(value: Column, low: Column, high: Column, count_nulls: bool) -> Column:
    """Share of values outside; nulls are skipped, or counted as outside."""
    outside = F.when(~value.between(low, high), 1.0).otherwise(0.0)
    if count_nulls:
        return F.avg(F.when(value.isNull(), 1.0).otherwise(outside))
    return F.avg(F.when(value.isNotNull(), outside))


def _as_moment(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.TimestampType):
        return to_utc_naive(F.col(field.name))
    if is_datetime(field):
        return F.col(field.name).cast("timestamp_ntz")
    return any_moment(F.col(field.name))


def validate(
    df: DataFrame,
    suite: Mapping[str, Any],
    dataset: Mapping[str, Any] | None = None,
    defaults: Mapping[str, Any] | None = None,
    count_nulls: bool = False,
    strict_types: bool = False,
) -> DataFrame:
    """Findings of ``df`` against ``suite``.

    ``dataset`` may hold ``thresholds``, per-column ``columns`` overrides and
    ``strict_structure``; ``defaults`` holds the same thresholds for all tables.
    Missing columns always fail, extra ones only under strict structure (the
    default). ``count_nulls`` counts null numbers as out of bounds. A column whose
    type no longer allows its bounds check is reported, and fails under ``strict_types``.
    """
    dataset, defaults = dataset or {}, defaults or {}
    strict = bool(dataset.get("strict_structure", defaults.get("strict_structure", True)))
    expected = suite["columns"]
    nothing = F.lit(None).cast("string")
    found: list[Column] = []
    measures: list[Column] = [F.count(F.lit(1)).alias("rows")]

    for c in sorted(set(expected) - set(df.columns)):
        found.append(_finding(c, "missing_column", F.lit(1.0), 0.0, nothing))
    for c in sorted(set(df.columns) - set(expected)):
        found.append(_finding(c, "extra_column", F.lit(1.0), 0.0, nothing, F.lit(not strict)))

    def measure(value: Column) -> Column:
        name = f"m{len(measures)}"
        measures.append(value.alias(name))
        return F.col(name)

    for c, spec in expected.items():
        if c not in df.columns:
            continue
        field, col = df.schema[c], F.col(c)

        def limit(key: str, column: str = c) -> float:
            return resolve_threshold(key, column, dataset, defaults)

        base_pp = float(spec.get("null_rate") or 0.0) * 100.0
        null_pp = measure(F.avg(value_of(df, c).isNull().cast("int")) * 100.0)
        found.append(
            _finding(c, "null_rate", null_pp - base_pp, limit("null_delta_pp"), F.lit(f"baseline {base_pp:.1f}%"))
        )
        if "num_bounds" in spec:
            low, high = spec["num_bounds"]["low"], spec["num_bounds"]["high"]
            if is_numeric(field):
                value = F.when(~F.isnan(col.cast("double")), col)
                share = measure(_out_of_bounds(value, F.lit(low), F.lit(high), count_nulls))
                found.append(_finding(c, "bounds", share, limit("oob_ratio"), F.lit(f"[{low}, {high}]")))
            else:
                note = f"{spec.get('dtype', 'numeric')} became {logical_type(field)}; bounds not checked"
                found.append(_finding(c, "type", F.lit(1.0), 0.0, F.lit(note), F.lit(not strict_types)))
        if "categories" in spec:
            known = [str(v) for v in spec["categories"]]
            share = measure(F.avg(_novel(col, known).cast("int")))
            found.append(_finding(c, "categories", share, limit("new_cat_ratio"), F.lit(f"{len(known)} known")))
        if "datetime_bounds" in spec:
            low, high = spec["datetime_bounds"]["low"], spec["datetime_bounds"]["high"]
            bounds = [F.lit(str(b)).cast("timestamp_ntz") for b in (low, high)]
            moment = _as_moment(field)
            outside = F.when((moment < bounds[0]) | (moment > bounds[1]), 1.0).otherwise(0.0)
            share = measure(F.avg(outside))
            found.append(_finding(c, "dates", share, limit("oob_ratio"), F.lit(f"[{low}, {high}]")))

    findings = F.array(*found) if found else F.array().cast(f"array<{FINDING_TYPE}>")
    return df.agg(*measures).select(F.explode(findings).alias("f")).select("f.*")


def novel_categories(df: DataFrame, suite: Mapping[str, Any]) -> DataFrame:
    """Every value missing from the profile, with its rows: ``name``, ``value``, ``n``."""
    listed = {c: [str(v) for v in s["categories"]] for c, s in suite["columns"].items() if "categories" in s}
    entries = [
        F.when(
            _novel(F.col(c), known), F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value"))
        )
        for c, known in listed.items()
        if c in df.columns
    ]
    if not entries:
        return df.sparkSession.createDataFrame([], "name string, value string, n bigint")
    return (
        df.select(F.explode(F.array_compact(F.array(*entries))).alias("e"))
        .groupBy("e.name", "e.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """``name, value, n`` for every present value of the columns, as text."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in cols])
    present = df.select(F.explode(pairs).alias("p")).where("p.value is not null")
    return present.groupBy("p.name", "p.value").agg(F.count(F.lit(1)).alias("n"))


def category_table(df: DataFrame, cols: str | Iterable[str]) -> DataFrame:
    """``name, value``: a baseline of categories as a table, for lists too long for a suite."""
    return _value_counts(df, as_list(cols)).select("name", "value")


def novel_values(df: DataFrame, known: DataFrame, cols: str | Iterable[str]) -> DataFrame:
    """``name, value, n``: values that are not in a baseline table, with their rows.

    The values are counted first, so a frequent one crosses the shuffle once per task, and the
    anti join meets each value once. Nulls are not values on either side.
    """
    baseline = known.where("value is not null").select("name", F.col("value").cast("string").alias("value"))
    return _value_counts(df, as_list(cols)).join(baseline, ["name", "value"], "left_anti")


def validate_long_categories(
    df: DataFrame,
    known: DataFrame,
    cols: str | Iterable[str],
    dataset: Mapping[str, Any] | None = None,
    defaults: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Findings like those of :func:`validate` for categories whose baseline is a table ``known(name, value)``.

    ``observed`` is the share of all rows whose value the baseline does not have; 0 for an empty
    table. A column without a baseline has only new values. Nothing is held by the driver.
    """
    names = as_list(cols)
    limits = {c: resolve_threshold("new_cat_ratio", c, dataset, defaults) for c in names}
    fresh = novel_values(df, known, names).groupBy("name").agg(F.sum("n").alias("fresh"))
    listed = known.where("value is not null").groupBy("name").agg(F.count_distinct("value").alias("known"))
    # One row per checked column.
    frame = df.sparkSession.createDataFrame(list(limits.items()), "name string, threshold double")
    total = df.agg(F.count(F.lit(1))).scalar()
    observed = F.coalesce(F.try_divide(F.coalesce("fresh", F.lit(0)).cast("double"), total), F.lit(0.0))
    joined = frame.join(fresh, "name", "left").join(listed, "name", "left").withColumn("observed", observed)
    return joined.select(
        "name", F.lit("categories").alias("check"), "observed", "threshold", (F.col("observed") <= F.col("threshold")).alias("passed"),
        F.concat(F.coalesce("known", F.lit(0)).cast("string"), F.lit(" known")).alias("detail"),
    )


def failures(findings: DataFrame) -> DataFrame:
    return findings.filter(~F.col("passed"))


def assert_valid(findings: DataFrame) -> None:
    """Raise :class:`ValidationError` listing the failed checks (one per column and check)."""
    failed = failures(findings).toArrow().to_pylist()
    if failed:
        lines = [f"{f['name']}: {f['check']} {f['observed']:.4g} > {f['threshold']:.4g}" for f in failed]
        raise ValidationError("; ".join(lines))


def _failure(spark: SparkSession, dataset: str, check: str, message: str) -> DataFrame:
    values = [(dataset, None, check, None, None, False, message)]
    return spark.createDataFrame(
        values,
        "dataset string, name string, check string, observed double, threshold double, "
        "passed boolean, detail string",
    )


def validate_many(
    spark: SparkSession,
    datasets: Mapping[str, Mapping[str, Any]],
    load: Callable[[Mapping[str, Any]], DataFrame] | None = None,
    defaults: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Findings of several tables, with the table's name in ``dataset``.

    Each entry holds a frame as ``df`` (or whatever ``load`` understands), a
    ``suite`` and optionally ``thresholds``, ``columns``, ``strict_structure``,
    ``enabled``, and for long category lists ``known``, a frame (name, value), with the columns
    it is for in ``known_cols``. A table that cannot be loaded or has no suite gives one failed
    finding, so nothing is skipped silently.
    """
    parts: list[DataFrame] = []
    for name, spec in datasets.items():
        if spec.get("enabled") is False or spec.get("validate") is False:
            continue
        try:
            df = spec["df"] if load is None else load(spec)
        except Exception as error:
            parts.append(_failure(spark, name, "load", str(error)))
            continue
        if not spec.get("suite"):
            parts.append(_failure(spark, name, "suite", "no suite given"))
            continue
        try:
            checked = validate(df, spec["suite"], spec, defaults)
            if spec.get("known") is not None:
                checked = checked.unionByName(validate_long_categories(df, spec["known"], spec["known_cols"], spec, defaults))
            parts.append(checked.select(F.lit(name).alias("dataset"), "*"))
        except Exception as error:
            parts.append(_failure(spark, name, "run", str(error)))
    if not parts:
        return _failure(spark, "", "", "").limit(0)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
