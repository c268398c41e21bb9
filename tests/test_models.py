"""Invariants of splits, models and metrics."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from lapsekit.operators import folds, metrics, models
from lapsekit.session import shared_folder


@pytest.fixture(scope="module")
def frame(spark):
    """Two classes, 8 : 1, with a gap in a number and in a category."""
    n = F.col("id")
    return spark.range(900).select(
        n.alias("key"),
        F.when(n % 7 != 0, (n * 37 % 101).cast("double")).alias("a"),
        (n * 53 % 17).cast("double").alias("b"),
        F.when(n % 5 != 0, F.concat(F.lit("s"), n % 3)).alias("s"),
        ((n * 37 % 101) + (n % 3) * 10 < 15).cast("int").alias("y"),
    )


CONFIG = {"target": "y", "id_cols": ["key"], "model": {"name": "logreg"}}


def test_folds_are_stratified_and_stable(spark, frame):
    for width in (1, 8):
        got = folds.kfold_assign(frame.repartition(width), "y", "key", 5)
        sizes = got.groupBy("y", "fold").count().collect()
        for label in (0, 1):
            counts = [r["count"] for r in sizes if r["y"] == label]
            assert len(counts) == 5 and max(counts) - min(counts) <= 1
        pairs = {r["key"]: r["fold"] for r in got.collect()}
        if width == 1:
            first = pairs
    assert pairs == first and len(pairs) == 900
    coarse = folds.kfold_assign(frame, "y", "key", 5, range_bits=1)
    assert {r["key"]: r["fold"] for r in coarse.collect()} == first
    other = folds.kfold_assign(frame, "y", "key", 5, seed=1)
    assert {r["key"]: r["fold"] for r in other.collect()} != first


def test_holdout_counts(frame):
    got = folds.holdout_split(frame, "y", "key", 0.2)
    assert got.filter("is_test").count() == 180
    share = got.groupBy("is_test").agg(F.avg("y").alias("m")).collect()
    assert abs(share[0]["m"] - share[1]["m"]) < 0.01
    assert folds.holdout_split(frame, None, "key", 0.15).filter("is_test").count() == 135


def test_fit_predict_save(spark, frame):
    fitted = models.fit(CONFIG, frame)
    rows = fitted.predictions.collect()
    assert fitted.predictions.columns == ["key", "y_true", "y_pred", "proba_0", "proba_1"] and len(rows) == 180
    assert all(abs(r["proba_0"] + r["proba_1"] - 1) < 1e-9 for r in rows)
    found = {r["metric"]: r["value"] for r in fitted.metrics.collect()}
    assert set(found) == {"accuracy", "f1_macro", "precision_macro", "recall_macro", "roc_auc"}
    assert found["roc_auc"] > 0.8
    place = shared_folder(spark, "model")
    models.save_model(fitted.model, place)
    again = models.predict(models.load_model(place), frame.drop("y"), "key", keep=[])
    scored = {r["key"]: r["proba_1"] for r in again.collect()}
    assert len(scored) == 900 and all(abs(scored[r["key"]] - r["proba_1"]) < 1e-12 for r in rows)
    refit = {r["key"]: r["proba_1"] for r in models.fit(CONFIG, frame).predictions.collect()}
    assert all(abs(refit[r["key"]] - r["proba_1"]) < 1e-6 for r in rows)


def test_preprocessing_handles_unseen_categories(frame):
    pipeline, numeric, categorical = models.build_pipeline(CONFIG, frame)
    assert (numeric, categorical) == (["a", "b"], ["s"])
    model = models.fit_pipeline(pipeline, frame, "y", [0, 1])
    strange = frame.limit(3).withColumn("s", F.lit("it's \\ new"))
    assert models.predict(model, strange, "key").count() == 3


def test_forest_and_importance(spark, frame):
    config = {**CONFIG, "model": {"name": "rf", "params": {"n_estimators": 10, "max_depth": 5}}}
    fitted = models.fit(config, frame)
    top = models.feature_importance(spark, fitted.model, frame).collect()
    assert top[0]["feature"] == "a" and abs(sum(r["importance"] for r in top) - 1) < 1e-9
    assert {r["feature"] for r in top} == {"a", "b", "s_s0", "s_s1", "s_s2"}


def test_cross_validation_names(frame):
    found = {r["metric"]: r["value"] for r in models.cross_validate({**CONFIG, "cv": {"n_splits": 3}}, frame).collect()}
    assert set(found) == set(metrics.scoring_names(2)) and all(0 <= v <= 1 for v in found.values())


def test_three_classes(frame):
    config = {"target": "s", "id_cols": ["key"], "model": {"name": "logreg", "params": {"max_iter": 20}}}
    fitted = models.fit(config, frame.filter("s IS NOT NULL"))
    assert "roc_auc_ovr_weighted" in {r["metric"] for r in fitted.metrics.collect()}
    assert fitted.predictions.columns[-3:] == ["proba_s0", "proba_s1", "proba_s2"]


def test_null_target_is_refused(frame):
    with pytest.raises(ValueError, match="nulls"):
        models.fit(CONFIG, frame.withColumn("y", F.when(F.col("key") > 3, F.col("y"))))


def test_model_parameters():
    with pytest.raises(ValueError):
        models.build_model("svm")
    with pytest.raises(ValueError):
        models.build_model("rf", {"no_such": 1})
    assert models.build_model("rf", {"n_estimators": 7, "n_jobs": -1}).getNumTrees() == 7


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_auc_equals_the_evaluator(spark, sf_dir, limit):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        (F.col("l_returnflag") == "R").cast("double").alias("label"), F.col("l_extendedprice").alias("score")
    )
    mine = metrics.roc_auc(lines, "label", "score", 1.0, single_task_bytes=limit).first()["roc_auc"]
    theirs = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(lines)
    assert abs(mine - theirs) < 1e-9


def test_dry_run(frame):
    got = models.dry_run(CONFIG, frame)
    assert got["rows"] == 200 and got["numeric_features"] == ["a", "b"] and got["scoring"][0] == "f1"


def test_zero_division(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "l int, p int")
    row = metrics.binary_metrics(df, "l", "p").first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)
    assert metrics.roc_auc(df.filter("l = 1"), "l", "p").first()["roc_auc"] is None


@pytest.mark.parametrize("name", ["logreg", "rf"])
def test_balanced_weights_and_boolean_targets(spark, name):
    df = spark.range(400).selectExpr("id", "id % 10 = 0 AS gone", "CAST(id % 10 = 0 AS DOUBLE) * 0.4 + rand(3) AS x")
    params = {"max_depth": 3, "n_estimators": 20} if name == "rf" else {}
    shares = []
    for weight in (None, "balanced", {"true": 1.0, "false": 1.0}):
        config = {"target": "gone", "id_cols": ["id"], "numeric_features": ["x"], "model": {"name": name, "params": {**params, "class_weight": weight}}}
        fitted = models.fit(config, df)
        assert fitted.classes == ["false", "true"]
        assert {f.name: f.dataType.simpleString() for f in fitted.predictions.schema}["y_pred"] == "boolean"
        shares.append(fitted.predictions.filter("y_pred").count())
    assert shares[1] > shares[0] == shares[2]
    with pytest.raises(ValueError):
        models.build_model(name, {"class_weight": "heavy"})


def test_double_targets_keep_sparks_names(spark):
    df = spark.range(60).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 1e10 ELSE 0.5 END AS y", "CAST(id % 2 AS DOUBLE) AS x")
    fitted = models.fit({"target": "y", "id_cols": ["id"], "numeric_features": ["x"], "model": {"name": "logreg"}}, df)
    assert fitted.classes == ["0.5", "1.0E10"] and fitted.predictions.filter("y_pred = y_true").count() == 12


def test_wide_text_columns_are_refused(spark):
    df = spark.range(500).selectExpr("id", "CAST(id % 2 AS INT) AS y", "CAST(id AS STRING) AS name", "CAST(id % 7 AS DOUBLE) AS x")
    config = {"target": "y", "id_cols": ["id"], "max_categories": 100, "model": {"name": "logreg"}}
    with pytest.raises(ValueError, match="more than 100 categories"):
        models.fit(config, df)
