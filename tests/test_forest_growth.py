"""Forests of larger tables are grown a tree at a time; the source rows are read once."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lapsekit.operators import forest, models
from lapsekit.session import shared_folder

SPEC = {
    "seed": 5, "n_trees": 1, "n_classes": 3, "weights": [1.0, 2.0, 1.0], "cuts": [np.arange(7.0)] * 4, "n_bins": 8, "kind": "|u1", "n_tried": 4,
    "max_depth": 6, "rate": 1.0, "impurity": "gini", "min_rows": 3, "min_gain": 0.0, "min_share": 0.0,
}


def grown(spec, n=700, number=0):
    rng = np.random.default_rng(1)
    bins = rng.integers(0, 8, (4, n))
    label = (bins[0] + rng.integers(0, 5, n) > 7).astype(int) + (bins[1] > 5)
    codes = (bins * 3 + label).astype(np.uint8)
    tree = forest._Tree(spec, number, codes, np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n, np.uint8))
    tree.grow()
    nodes = [r["nodeData"] for b in tree.table() for r in b.to_pylist()]
    return bins, label, tree.weight.astype(float), nodes


def impurity(counts, kind):
    share = counts / counts.sum()
    return 1 - (share**2).sum() if kind == "gini" else -sum(p * np.log2(p) for p in share if p)


@pytest.mark.parametrize("kind", ["gini", "entropy"])
def test_each_split_is_the_best_of_all(kind):
    spec = {**SPEC, "impurity": kind}
    bins, label, weight, nodes = grown(spec)
    assert [n["id"] for n in nodes] == list(range(len(nodes))) and len(nodes) > 20 and 1.4 > weight.mean() > 0.6

    def counts(rows, weighted=True):
        found = np.bincount(label[rows], weight[rows], 3)
        return found * spec["weights"] if weighted else found

    def check(node, rows, depth):
        assert np.allclose(node["impurityStats"], counts(rows)) and node["rawCount"] == counts(rows, False).sum()
        assert node["prediction"] == counts(rows).argmax()
        if node["leftChild"] < 0:
            return
        assert depth < spec["max_depth"]
        own, best = impurity(counts(rows), kind), -1
        for f in range(4):
            for b in range(7):
                left, right = rows[bins[f][rows] <= b], rows[bins[f][rows] > b]
                if min(counts(left, False).sum(), counts(right, False).sum()) >= 3:
                    share = counts(left).sum() / counts(rows).sum()
                    best = max(best, own - share * impurity(counts(left), kind) - (1 - share) * impurity(counts(right), kind))
        assert node["gain"] == pytest.approx(best)
        goes = bins[node["split"]["featureIndex"]][rows] <= node["split"]["leftCategoriesOrThreshold"][0]
        sides = nodes[node["leftChild"]], nodes[node["rightChild"]]
        assert any(s["leftChild"] >= 0 for s in sides) or sides[0]["prediction"] != sides[1]["prediction"]
        check(sides[0], rows[goes], depth + 1)
        check(sides[1], rows[~goes], depth + 1)

    check(nodes[0], np.flatnonzero(weight), 0)


@pytest.mark.parametrize("tried", [2, 4])
def test_pieces_do_not_change_a_tree(monkeypatch, tried):
    spec = {**SPEC, "n_tried": tried}
    first = grown(spec)[3]
    for piece, small, room in ((50, 2048, 1 << 23), (37, 0, 1 << 23), (1 << 18, 8, 1 << 23), (1, 1, 1)):
        monkeypatch.setattr(forest, "PIECE", piece)
        monkeypatch.setattr(forest, "SMALL_NODE", small)
        if tried == 4:
            monkeypatch.setattr(forest, "HISTOGRAM_BYTES", room)
        elif room == 1:
            continue
        assert grown(spec)[3] == first
    assert grown(spec, number=1)[3] != first


def test_depth_and_empty_bags():
    assert len(grown({**SPEC, "max_depth": 0})[3]) == 1
    assert len(grown({**SPEC, "max_depth": 1})[3]) <= 3
    assert len(grown({**SPEC, "rate": 1e-12})[3]) == 1


def test_candidate_splits():
    few, ones = np.array([1.0, 2.0, 4.0]), np.ones(3)
    assert forest.candidate_splits(few, ones, 31).tolist() == [1.5, 3.0]
    assert forest.candidate_splits(np.array([5.0]), np.ones(1), 31).tolist() == []
    many = np.arange(1000.0)
    assert np.allclose(forest.candidate_splits(many, np.ones(1000), 3), [249.5, 499.5, 749.5], atol=1)
    values = np.random.default_rng(2).normal(size=100_000).round(4)
    v, w = forest._summary(values, np.ones(len(values)), 500)
    assert len(v) <= 500 and w.sum() == len(values) and (np.diff(v) > 0).all()
    middle = forest.candidate_splits(v, w, 3)
    assert np.allclose([(values <= m).mean() for m in middle], [0.25, 0.5, 0.75], atol=0.005)
    assert [forest.subset_size(s, 10, 300) for s in ("sqrt", "auto", "all", "log2", "onethird", "3", "0.25", "99")] == [4, 4, 10, 4, 4, 3, 3, 10]


@pytest.fixture(scope="module")
def frame(spark):
    df = spark.range(12_000).select("id", *[F.rand(i).alias(f"a{i}") for i in range(3)], (F.col("id") % 2).cast("double").alias("h"))
    df = df.withColumn("y", (2 * F.col("a0") + F.col("a1") * F.col("h") + F.rand(9) > 1.8).cast("double"))
    place = shared_folder(spark, "forest-test")
    VectorAssembler(inputCols=["a0", "a1", "a2", "h"], outputCol="features").transform(df).write.parquet(place)
    return spark.read.parquet(place)


def test_large_table_as_sparks_own(spark, frame, monkeypatch):
    params = {"labelCol": "y", "numTrees": 12, "maxDepth": 6, "seed": 3}
    train, rest = frame.where("id % 4 != 0"), frame.where("id % 4 = 0")
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda *a: pytest.fail("Spark's own forest"))
    monkeypatch.setattr(forest.Forest, "few_rows", 8999)
    model = forest.Forest(**params).fit(train)
    monkeypatch.undo()
    own = RandomForestClassifier(**params).fit(train)
    area = [BinaryClassificationEvaluator(labelCol="y").evaluate(m.transform(rest)) for m in (model, own)]
    assert area[0] > 0.85 and abs(area[0] - area[1]) < 0.02
    assert np.allclose(model.featureImportances.toArray(), own.featureImportances.toArray(), atol=0.1)
    assert model.getNumTrees == own.getNumTrees == 12 and model.numClasses == 2 and model.numFeatures == 4 and model.getMaxDepth() == 6
    place = shared_folder(spark, "model")
    model.save(place)
    assert type(model).load(place).totalNumNodes == model.totalNumNodes
    assert forest.Forest(**params).fit(train).totalNumNodes != 0


def test_few_rows_stay_with_sparks_own(frame):
    params = {"labelCol": "y", "numTrees": 3, "maxDepth": 3, "seed": 3}
    small = frame.where("id < 2000")
    assert forest.Forest(**params).fit(small).toDebugString.split(")", 1)[1] == RandomForestClassifier(**params).fit(small).toDebugString.split(")", 1)[1]


def test_class_weights_and_categories(spark, frame, monkeypatch):
    """Through the pipeline, with balanced classes and a text column."""
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda *a: pytest.fail("Spark's own forest"))
    monkeypatch.setattr(forest.Forest, "few_rows", 0)
    df = frame.select("id", "a0", "a1", F.concat(F.lit("s"), F.col("h")).alias("s"), (F.col("y") + (F.col("a2") > 0.9).cast("int")).cast("int").alias("k"))
    config = {"target": "k", "id_cols": ["id"], "model": {"name": "rf", "params": {"n_estimators": 6, "max_depth": 5, "class_weight": "balanced"}}}
    fitted = models.fit(config, df)
    found = {r["metric"]: r["value"] for r in fitted.metrics.collect()}
    assert found["roc_auc_ovr_weighted"] > 0.7
    rows = fitted.predictions.collect()
    assert len(rows) == 2400 and all(abs(r["proba_0"] + r["proba_1"] + r["proba_2"] - 1) < 1e-9 for r in rows)
    top = models.feature_importance(spark, fitted.model, df).collect()
    assert top[0]["feature"] == "a0" and abs(sum(r["importance"] for r in top) - 1) < 1e-9


def test_fit_reads_its_rows_once(spark):
    """The split, its quotas and totals used to read the given frame again each time."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(v):
        seen.add(1)
        return float(v % 13)

    df = spark.range(500).select("id", F.col("id").alias("b"), (F.col("id") % 3 == 0).cast("int").alias("y")).withColumn("a", counted("id"))
    models.fit({"target": "y", "id_cols": ["id"], "model": {"name": "logreg"}}, df).metrics.collect()
    assert seen.value == 500
