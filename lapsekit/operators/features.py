"""Feature preparation: dummies, imputation, scaling, and the fitted preprocessor."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from lapsekit.operators.columns import as_list
from lapsekit.operators.quantiles import exact_quantiles

# Each category becomes a column; a table much wider than this cannot be planned.
MAX_DUMMIES = 10_000


def category_values(df: DataFrame, cols: str | Iterable[str]) -> dict[str, list[str]]:
    """Sorted present values per column; one job, an error beyond :data:`MAX_DUMMIES` values."""
    names = as_list(cols)
    found = _value_pairs(df, names).distinct().limit(MAX_DUMMIES + 1).toArrow().to_pylist()
    if len(found) > MAX_DUMMIES:
        raise ValueError(f"{names} have more than {MAX_DUMMIES} values; they cannot become columns")
    values: dict[str, list[str]] = {c: [] for c in names}
    for row in found:
        values[row["name"]].append(row["value"])
    return {c: sorted(v) for c, v in values.items()}


def get_dummies(df: DataFrame, cols: str | Iterable[str]) -> DataFrame:
    """Replace each column by one 0/1 column ``<column>_<value>`` per value; null is all zeros."""
    values = category_values(df, cols)
    made = [
        F.when(F.col(c).cast("string") == v, 1).otherwise(0).alias(f"{c}_{v}")
        for c, vs in values.items()
        for v in vs
    ]
    return df.select(*[c for c in df.columns if c not in values], *made)


def _value_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in cols])
    return df.select(F.explode(pairs).alias("p")).select("p.name", "p.value").filter("value is not null")


def most_frequent(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``name``, ``value``: the commonest present value as text, the smallest among equals.

    Values are counted by a partial aggregate, so no task holds a whole column.
    """
    counts = _value_pairs(df, cols).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("name").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value"))


def medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``name``, ``value``: the exact, interpolated median."""
    return exact_quantiles(df, cols, [0.5]).select("name", F.get("quantiles", F.lit(0)).alias("value"))


def _as_scalar_map(found: DataFrame) -> Column:
    """A (name, value) frame as one scalar map, so that all columns share a subquery."""
    return found.agg(F.map_from_entries(F.collect_list(F.struct("name", "value")))).scalar()


def _number(c: str) -> Column:
    return F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))


def impute_median(df: DataFrame, cols: str | Iterable[str]) -> DataFrame:
    """Fill nulls (and NaN) with the column's median; columns become doubles."""
    names = as_list(cols)
    fill = _as_scalar_map(medians(df, names))
    return df.withColumns({c: F.coalesce(_number(c), F.element_at(fill, F.lit(c))) for c in names})


def impute_mode(df: DataFrame, cols: str | Iterable[str]) -> DataFrame:
    """Fill nulls with the column's most frequent value."""
    names = as_list(cols)
    fill = _as_scalar_map(most_frequent(df, names))
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.element_at(fill, F.lit(c)).cast(df.schema[c].dataType)) for c in names}
    )


def standardize(df: DataFrame, cols: str | Iterable[str]) -> DataFrame:
    """Zero mean and unit population deviation; a constant column becomes 0."""
    names = as_list(cols)
    moments = df.agg(
        F.struct(*[f(_number(c)).alias(f"{m}_{c}") for c in names for m, f in (("mean", F.avg), ("std", F.stddev_pop))])
    ).scalar()
    scaled = {}
    for c in names:
        centred = _number(c) - moments[f"mean_{c}"]
        scaled[c] = F.when(moments[f"std_{c}"] == 0, centred * 0).otherwise(F.try_divide(centred, moments[f"std_{c}"]))
    return df.withColumns(scaled)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class FillAndScale(Estimator):
    """Learns imputation and scaling and returns them as one SQL projection.

    Numbers: median for nulls, then population standardisation. Categories: the
    most frequent value for nulls, as text. The fitted stage is Spark's own
    ``SQLTransformer``, so it is saved and loaded like any built-in stage.
    Fitting fetches one number or word per column.
    """

    def __init__(self, numeric: Sequence[str], categorical: Sequence[str], max_categories: int = MAX_DUMMIES):
        super().__init__()
        self.numeric, self.categorical, self.max_categories = list(numeric), list(categorical), max_categories

    def _refuse_wide(self, sizes: Mapping[str, int]) -> None:
        wide = sorted(c for c, n in sizes.items() if n > self.max_categories)
        if wide:
            raise ValueError(f"more than {self.max_categories} categories in {wide}; leave these columns out, hash them or raise max_categories")

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        parts = []
        sizes = {c: F.approx_count_distinct(c).alias(f"d_{c}") for c in self.categorical}
        if not self.numeric and sizes:
            row = dataset.agg(*sizes.values()).first()
            self._refuse_wide({c: row[f"d_{c}"] for c in sizes})
        if self.numeric:
            centre = {r["name"]: r["value"] for r in medians(dataset, self.numeric).toArrow().to_pylist()}
            filled = {c: F.coalesce(_number(c), F.lit(centre.get(c) or 0.0)) for c in self.numeric}
            row = dataset.agg(
                *[F.avg(v).alias(f"m_{c}") for c, v in filled.items()],
                *[F.stddev_pop(v).alias(f"s_{c}") for c, v in filled.items()],
                *sizes.values(),
            ).first()
            self._refuse_wide({c: row[f"d_{c}"] for c in sizes})
            for c in self.numeric:
                mean, std = float(row[f"m_{c}"]), float(row[f"s_{c}"]) or 1.0
                value = f"nanvl(CAST({_quoted(c)} AS DOUBLE), NULL)"
                parts.append(
                    f"(coalesce({value}, {float(centre.get(c) or 0.0)!r}D) - ({mean!r}D)) / {std!r}D "
                    f"AS {_quoted('num__' + c)}"
                )
        if self.categorical:
            common = {r["name"]: r["value"] for r in most_frequent(dataset, self.categorical).toArrow().to_pylist()}
            for c in self.categorical:
                fill = _text_literal(common[c]) if c in common else "CAST(NULL AS STRING)"
                parts.append(f"coalesce(CAST({_quoted(c)} AS STRING), {fill}) AS {_quoted('cat__' + c)}")
        return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def preprocessor(
    numeric: Sequence[str],
    categorical: Sequence[str],
    output: str = "features",
    max_categories: int = MAX_DUMMIES,
    vectors: Sequence[str] = (),
) -> Pipeline:
    """Impute and scale numbers, impute and one-hot categories, assemble one vector.

    The categories of a column are fetched to the driver and each becomes a slot. A
    column with (by a sketch) more than ``max_categories``, such as a name or an id, is an error
    before anything is fetched; encode it with :func:`lapsekit.operators.hashing.hashed_vector` and name
    the result in ``vectors``, which are assembled as they are.

    Categories unseen at fitting time are all zeros. Other columns are not used.
    """
    stages: list = [FillAndScale(numeric, categorical, max_categories)]
    inputs = [f"num__{c}" for c in numeric]
    if categorical:
        stages += [
            StringIndexer(
                inputCols=[f"cat__{c}" for c in categorical],
                outputCols=[f"idx__{c}" for c in categorical],
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            # The "keep" slot of the indexer is the last one and is what dropLast drops.
            OneHotEncoder(
                inputCols=[f"idx__{c}" for c in categorical],
                outputCols=[f"hot__{c}" for c in categorical],
                dropLast=True,
            ),
        ]
        inputs += [f"hot__{c}" for c in categorical]
    stages.append(VectorAssembler(inputCols=[*inputs, *vectors], outputCol=output, handleInvalid="error"))
    return Pipeline(stages=stages)


def dated_feature_pipeline(
    numeric: Sequence[str], categorical: Sequence[str], gaps: Mapping[str, tuple[str, str]]
) -> tuple[Pipeline, Mapping[str, tuple[str, str]]]:
    """The preprocessor for scaled numbers, one-hot categories and hour gaps between dates.

    Returns the pipeline and the gaps to add first with ``add_order_lags``; the
    gaps are assembled unscaled. Every row stays: a gap with a missing date is NaN.
    """
    pipeline = preprocessor(numeric, categorical, output="scaled")
    whole = VectorAssembler(inputCols=["scaled", *gaps], outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[*pipeline.getStages(), whole]), gaps
