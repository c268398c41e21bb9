"""Baseline classifiers: build, cross-validate, fit, score, save and load."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import IndexToString
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lapsekit.operators import metrics as M
from lapsekit.operators.columns import as_list, feature_types
from lapsekit.operators.features import preprocessor
from lapsekit.operators.folds import holdout_split, kfold_assign, range_bits_for
from lapsekit.operators.forest import Forest
from lapsekit.plans.sizing import SINGLE_TASK_BYTES, fits
from lapsekit.session import materialize

LABEL, WEIGHT = "__label", "__weight"
MAX_CLASSES = 1000

# Parameter names accepted in a model configuration -> Spark's names (fixed values).
LOGREG_PARAMS = {"max_iter": "maxIter", "tol": "tol", "fit_intercept": "fitIntercept"}
FOREST_PARAMS = {
    "n_estimators": "numTrees",
    "max_depth": "maxDepth",
    "max_bins": "maxBins",
    "max_features": "featureSubsetStrategy",
    "min_samples_leaf": "minInstancesPerNode",
    "min_impurity_decrease": "minInfoGain",
    "max_samples": "subsamplingRate",
    "criterion": "impurity",
    "random_state": "seed",
}
# Accepted and without effect: Spark schedules its own parallelism and solver.
IGNORED_PARAMS = {"n_jobs", "solver", "verbose"}
PENALTIES = {"l2": 0.0, "l1": 1.0, None: 0.0, "none": 0.0}


class ScaledLogisticRegression(Estimator):
    """Logistic regression with inverse regularisation strength ``C``.

    The loss here is a mean over rows where ``C`` weighs a sum, so the strength
    depends on the number of training rows and is set when fitting.
    """

    class_weight: Any = None

    def __init__(self, c: float = 1.0, penalty: str | None = "l2", **params: Any):
        super().__init__()
        self.c, self.penalty, self.extra = c, penalty, params

    def _fit(self, dataset: DataFrame):
        unpenalised = self.penalty in (None, "none")
        strength = 0.0 if unpenalised else 1.0 / (self.c * dataset.count())
        return LogisticRegression(
            featuresCol="features",
            labelCol=LABEL,
            regParam=strength,
            elasticNetParam=PENALTIES[self.penalty],
            standardization=False,
            **({"weightCol": WEIGHT} if self.class_weight else {}),
            **self.extra,
        ).fit(dataset)


def _renamed(params: Mapping[str, Any], names: Mapping[str, str]) -> dict[str, Any]:
    unknown = sorted(set(params) - set(names) - IGNORED_PARAMS)
    if unknown:
        raise ValueError(f"unknown model parameters: {unknown}")
    return {names[k]: v for k, v in params.items() if k in names and v is not None}


def build_model(name: str, params: Mapping[str, Any] | None = None) -> Estimator:
    """``logreg`` or ``rf`` with the given parameters over the defaults.

    ``class_weight`` is ``"balanced"`` (rows over classes times rows of the class) or
    a mapping from class to weight; rows are weighted in the loss or the impurity.
    """
    given = dict(params or {})
    weights = given.pop("class_weight", None)
    if weights is not None and weights != "balanced" and not isinstance(weights, Mapping):
        raise ValueError(f"class_weight must be 'balanced', a mapping or None, not {weights!r}")
    model = _model(name, given)
    model.class_weight = weights
    if weights and isinstance(model, RandomForestClassifier):
        model.setWeightCol(WEIGHT)
    return model


def _model(name: str, given: dict[str, Any]) -> Estimator:
    if name.lower() == "logreg":
        c, penalty = float(given.pop("C", 1.0)), given.pop("penalty", "l2")
        if penalty not in PENALTIES:
            raise ValueError(f"unknown penalty {penalty!r}")
        return ScaledLogisticRegression(c, penalty, **_renamed({"max_iter": 1000, **given}, LOGREG_PARAMS))
    if name.lower() == "rf":
        # Trees stop at this depth; Spark allows up to 30.
        defaults = {"n_estimators": 300, "max_depth": 12, "max_features": "sqrt", "random_state": 42}
        # Each row's node per tree is kept between passes rather than found again down every tree;
        # the trees are the same.
        return Forest(
            featuresCol="features", labelCol=LABEL, cacheNodeIds=True, **_renamed({**defaults, **given}, FOREST_PARAMS)
        )
    raise ValueError(f"unknown model: {name!r}")


def build_pipeline(
    config: Mapping[str, Any], df: DataFrame | None = None
) -> tuple[Pipeline, list[str], list[str]]:
    """The unfitted pipeline and its numeric and categorical features.

    Features not listed in the configuration are taken from the frame's types.
    ``max_categories`` bounds the categories of each text column; ``vector_features`` are vector
    columns that enter the model as they are, such as hashed categories.
    """
    numeric = list(config.get("numeric_features") or [])
    categorical = list(config.get("categorical_features") or [])
    if df is not None and not (numeric and categorical):
        found = feature_types(df, config["target"], config.get("id_cols"))
        numeric, categorical = numeric or found[0], categorical or found[1]
    model = config.get("model") or {}
    classifier = build_model(model.get("name", "logreg"), model.get("params"))
    most = {"max_categories": int(config["max_categories"])} if config.get("max_categories") else {}
    vectors = list(config.get("vector_features") or [])
    return Pipeline(stages=[preprocessor(numeric, categorical, vectors=vectors, **most), classifier]), numeric, categorical


def target_classes(df: DataFrame, target: str, most: int = MAX_CLASSES) -> list[Any]:
    """Sorted classes of the target, under the names that Spark's own cast to text gives them.

    Whole numbers and texts stay what they are. Null targets are an error, and so
    are more than ``most`` classes: the class names are held by the driver and each is a column of the result.
    """
    named = df.select(F.col(target), F.col(target).cast("string").alias("__name"))
    found = [(r[0], r[1]) for r in named.distinct().limit(most + 2).collect()]
    if any(v is None for v, _ in found):
        raise ValueError(f"target {target!r} has nulls; remove those rows first")
    if len(found) > most:
        raise ValueError(f"target {target!r} has more than {most} classes")
    return [n if isinstance(v, (bool, float)) else v for v, n in sorted(found)]


def with_label(df: DataFrame, target: str, classes: Sequence[Any]) -> DataFrame:
    """Add the class position as the numeric label Spark ML trains on."""
    known = F.array(*[F.lit(str(c)) for c in classes])
    place = F.array_position(known, F.col(target).cast("string")) - 1
    return df.withColumn(LABEL, place.cast("double"))


def _class_names(classes: Sequence[Any]) -> IndexToString:
    return IndexToString(inputCol="prediction", outputCol="predicted_class", labels=[str(c) for c in classes])


def _with_weight(labelled: DataFrame, classes: Sequence[Any], weights: str | Mapping[Any, float]) -> DataFrame:
    """Add the weight of each row's class; the counts of the classes are one row each."""
    if weights == "balanced":
        counts = {int(r[LABEL]): r["count"] for r in labelled.groupBy(LABEL).count().collect()}
        by_place = [sum(counts.values()) / (len(counts) * counts[i]) if i in counts else 1.0 for i in range(len(classes))]
    else:
        named = {str(k): float(v) for k, v in weights.items()}
        by_place = [named.get(str(c), 1.0) for c in classes]
    return labelled.withColumn(WEIGHT, F.get(F.array(*[F.lit(w) for w in by_place]), F.col(LABEL).cast("int")))


def fit_pipeline(pipeline: Pipeline, train: DataFrame, target: str, classes: Sequence[Any]) -> PipelineModel:
    """Fit on labelled rows; the last stage of the result names the predicted class."""
    labelled = with_label(train, target, classes)
    weights = getattr(pipeline.getStages()[-1], "class_weight", None)
    if weights:
        labelled = _with_weight(labelled, classes, weights)
    fitted = pipeline.fit(labelled)
    return PipelineModel(stages=[*fitted.stages, _class_names(classes)])


def model_classes(model: PipelineModel) -> list[str]:
    return list(model.stages[-1].getLabels())


def _probabilities(classes: Sequence[Any]) -> list[Column]:
    values = vector_to_array("probability")
    return [values[i].alias(f"proba_{c}") for i, c in enumerate(classes)]


def predict(
    model: PipelineModel,
    df: DataFrame,
    id_cols: str | Iterable[str] | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Ids, ``prediction`` (the class as text) and ``proba_<class>`` for every row.

    Row-local, so it works on a streaming frame too.
    """
    scored = model.transform(df)
    return scored.select(
        *as_list(id_cols),
        *keep,
        F.col("predicted_class").alias("prediction"),
        *_probabilities(model_classes(model)),
    )


def _score(name: Any) -> Column:
    return F.col(f"`proba_{name}`")


def evaluate(scored: DataFrame, label: str, classes: Sequence[Any]) -> DataFrame:
    """``metric``, ``value`` rows from a frame of labels, ``prediction`` and ``proba_<class>``."""
    wanted = M.scoring_names(len(classes))
    text = scored.withColumn("__truth", F.col(label).cast("string"))
    if len(classes) <= 2:
        positive = str(classes[-1])
        basic = M.binary_metrics(text, "__truth", "prediction", positive)
        ranked = M.roc_auc(text, "__truth", _score(classes[-1]), positive)
    else:
        basic = M.classification_metrics(text, "__truth", "prediction")
        ranked = M.roc_auc_ovr(text, "__truth", {c: _score(c) for c in classes})
    parts = []
    for source in (basic, ranked):
        names = [n for n in source.columns if n in wanted]
        pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])
        parts.append(source.select(F.explode(pairs).alias("m")).select("m.*"))
    return parts[0].unionByName(parts[1])


def cross_validate(config: Mapping[str, Any], df: DataFrame, parallelism: int = 1) -> DataFrame:
    """Mean of each metric over stratified folds: ``metric``, ``value``.

    ``config``: ``target``, ``id_cols``, ``model``, ``cv.n_splits``,
    ``random_state``. Preprocessing is learned on the training folds only. Each
    fit is distributed; ``parallelism`` fits run at a time.
    """
    target, seed = config["target"], int(config.get("random_state", 42))
    n_splits = int((config.get("cv") or {}).get("n_splits", 5))
    pipeline, _, _ = build_pipeline(config, df)
    folded = materialize(kfold_assign(df, target, config.get("id_cols"), n_splits, seed, "__fold"), "folds")
    classes = target_classes(folded, target)

    def one(fold: int) -> list[dict[str, Any]]:
        model = fit_pipeline(pipeline, folded.filter(F.col("__fold") != fold), target, classes)
        scored = predict(model, folded.filter(F.col("__fold") == fold), keep=[target])
        return evaluate(materialize(scored, "scored"), target, classes).toArrow().to_pylist()

    with ThreadPoolExecutor(parallelism) as pool:
        results = list(pool.map(inheritable_thread_target(df.sparkSession)(one), range(n_splits)))
    rows = [(r["metric"], fold, r["value"]) for fold, found in enumerate(results) for r in found]
    per_fold = df.sparkSession.createDataFrame(rows, "metric string, fold int, value double")
    return per_fold.groupBy("metric").agg(F.avg("value").alias("value"))


@dataclass
class FittedBaseline:
    """Outcome of :func:`fit`."""

    model: PipelineModel
    classes: list[Any]
    numeric: list[str]
    categorical: list[str]
    predictions: DataFrame
    metrics: DataFrame
    report: DataFrame


def fit(config: Mapping[str, Any], df: DataFrame) -> FittedBaseline:
    """Fit on a stratified training part and evaluate on the held-out rest.

    ``predictions`` holds ids, ``y_true``, ``y_pred`` and ``proba_<class>`` of the
    held-out rows; ``metrics`` holds accuracy, macro scores and the AUC. The rows, the split
    and the scored rows are written once to the shared folder, as all are read
    several times.
    """
    target, ids = config["target"], as_list(config.get("id_cols"))
    pipeline, numeric, categorical = build_pipeline(config, df)
    used = list(dict.fromkeys([*ids, target, *numeric, *categorical, *(config.get("vector_features") or [])]))
    if not numeric + categorical:
        used = df.columns
    # The split reads its rows several times; without ids it hashes all columns.
    rows = materialize(df.select(*used) if ids else df, "rows")
    parted = holdout_split(
        rows, target, ids, float(config.get("test_size", 0.2)), int(config.get("random_state", 42)), "__test",
        range_bits_for(df), fits(df, SINGLE_TASK_BYTES),
    )
    split = materialize(parted.select(*used, "__test"), "split")
    classes = target_classes(split, target)
    model = fit_pipeline(pipeline, split.filter(~F.col("__test")), target, classes)
    scored = materialize(
        predict(model, split.filter("__test"), ids, keep=[] if target in ids else [target]), "scored"
    )
    text = scored.withColumn("__truth", F.col(target).cast("string"))
    basic = M.classification_metrics(text, "__truth", "prediction")
    names = basic.columns
    basic = basic.select(
        F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])).alias("m")
    ).select("m.*")
    ranked = evaluate(scored, target, classes).filter(F.col("metric").startswith("roc_auc"))
    predictions = scored.select(
        *ids,
        F.col(target).alias("y_true"),
        F.col("prediction").cast(df.schema[target].dataType).alias("y_pred"),
        *[_score(c) for c in classes],
    )
    return FittedBaseline(
        model,
        classes,
        numeric,
        categorical,
        predictions,
        basic.unionByName(ranked),
        M.classification_report(text, "__truth", "prediction"),
    )


def save_model(model: PipelineModel, path: str) -> None:
    """Save a fitted pipeline; all of its stages are Spark's own."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_names(model: PipelineModel, df: DataFrame) -> list[str]:
    """Names of the vector's slots, from the schema of the transformed frame; no job."""
    attrs = model.transform(df).schema["features"].metadata["ml_attr"]["attrs"]
    found = [(a["idx"], a["name"]) for group in attrs.values() for a in group]
    return [name for _, name in sorted(found)]


def _slot_label(name: str) -> str:
    for start in ("num__", "hot__idx__", "hot__"):
        if name.startswith(start):
            return name[len(start) :]
    return name


def feature_importance(spark: SparkSession, model: PipelineModel, df: DataFrame, top: int = 20) -> DataFrame:
    """The ``top`` features of a fitted forest: ``feature``, ``importance``, largest first."""
    forest = next(s for s in model.stages if hasattr(s, "featureImportances"))
    values = forest.featureImportances.toArray().tolist()
    rows = [(_slot_label(n), float(v)) for n, v in zip(feature_names(model, df), values)]
    frame = spark.createDataFrame(rows, "feature string, importance double")
    return frame.orderBy(F.desc("importance"), "feature").limit(top)


def dry_run(config: Mapping[str, Any], df: DataFrame, rows: int = 200) -> dict[str, Any]:
    """What a fit would use, from the first ``rows`` rows and without training."""
    head = df.limit(rows)
    _, numeric, categorical = build_pipeline(config, head)
    present = [r[0] for r in head.select(config["target"]).distinct().collect() if r[0] is not None]
    return {
        "rows": head.count(),
        "columns": len(df.columns),
        "target": config["target"],
        "numeric_features": numeric,
        "categorical_features": categorical,
        "model": (config.get("model") or {}).get("name", "logreg"),
        "scoring": M.scoring_names(len(present)),
    }


