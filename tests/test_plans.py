"""The physical plans are the intended ones."""

import re

import pytest

import workloads
from lapsekit.sources import publish
from workloads.registry import QUERIES

workloads.load_all()
PYTHON_NODES = r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups"
WITH_PYTHON = {"strip_accents", "rowwise_udf"}
EAGER = {
    "fit_logreg", "fit_rf", "fit_logreg_multiclass", "cv_metrics", "predictions", "fit_report",
    "predict_saved_model", "feature_importance", "steps_master",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(plan):
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|Single)", plan))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_python_and_no_cross_product(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert name in WITH_PYTHON or not re.search(PYTHON_NODES, plan)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_pruning_and_pushdown(spark, sf_dir):
    plan = plan_of(QUERIES["sql_source_params"](spark, sf_dir))
    assert "EqualTo(o_orderstatus,F)" in plan
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double,o_orderpriority:string>" in plan


@pytest.mark.parametrize(
    "name, most",
    [("groupby_aggregate", 1), ("dedup_first", 1), ("payments_per_order", 1), ("validate_report", 1), ("null_counts", 1),
     ("corr_matrix", 1), ("cast_report", 1), ("lookup_broadcast", 0), ("rowwise_multi", 0), ("top_k", 0)],
)
def test_number_of_shuffles(spark, sf_dir, name, most):
    assert shuffles(plan_of(QUERIES[name](spark, sf_dir))) <= most


def executed(df):
    """The plan that ran, as the adaptive planner left it."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan_of(df).split("Initial Plan")[0]


def test_joins_are_not_hinted(spark):
    from lapsekit.operators.joins import join

    many = spark.range(1000).selectExpr("id as k", "explode(sequence(0, 300)) as x")
    planned = join(spark.range(5).selectExpr("id as k"), many, on="k")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in planned


def test_quantile_sketches_keep_their_size(spark):
    from lapsekit.operators import quantiles

    df = spark.range(50_000).selectExpr("CAST(pmod(id * 7919, 50000) AS DOUBLE) AS x", "CAST(id % 3 AS DOUBLE) AS y")
    got = {r["name"]: r["quantiles"] for r in quantiles.exact_quantiles(df, ["x", "y"], [0.25, 0.5, 0.99], accuracy=50, most=40).collect()}
    assert got == {"x": [12499.75, 24999.5, 49499.01], "y": [0.0, 1.0, 2.0]}
    wide = quantiles._brackets(df, ["x"], [0.5], 50, 10**9)["x"][0]
    narrow = quantiles._brackets(df, ["x"], [0.5], 50, 40)["x"][0]
    assert narrow[1] - narrow[0] <= 40 < wide[1] - wide[0]


def test_large_sides_are_not_broadcast(spark, monkeypatch, sf_dir):
    from lapsekit.plans import sizing

    big = spark.read.parquet(f"{sf_dir}/orders.parquet")
    assert sizing.fits(big, sizing.BROADCAST_BYTES) and not sizing.fits(big, 10)
    monkeypatch.setattr(sizing, "estimated_bytes", lambda df: None)
    assert not sizing.fits(big, sizing.BROADCAST_BYTES)


def test_label_takes_its_date_without_grouping(spark):
    from lapsekit.operators.labels import create_churn_label

    df = spark.range(1000).selectExpr("id % 50 as c", "timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, CAST(id % 200 AS INT)) as ts")
    plan = executed(create_churn_label(df, "c", "ts", filter_status_col=None))
    assert len(re.findall(r"hashpartitioning\(__customer", plan)) <= 2


def test_ranges_grow_with_the_table(spark, monkeypatch):
    from lapsekit.operators import folds
    from lapsekit.plans import sizing

    df = spark.range(10).selectExpr("CAST(id AS DOUBLE) AS x")
    assert folds.range_bits_for(df) == folds.RANGE_BITS
    monkeypatch.setattr(sizing, "estimated_bytes", lambda frame: 100 * 10**12)
    assert folds.range_bits_for(df) == folds.LARGE_RANGE_BITS
    assert folds.kfold_assign(df, None, "x", 5).groupBy("fold").count().count() == 5


def test_folds_accumulate_classes_not_ranges(spark):
    from lapsekit.operators import folds

    df = spark.range(4000).selectExpr("id", "CAST(id % 3 AS STRING) AS label")
    assigned = folds.kfold_assign(df, "label", "id", 5)
    rows = assigned.groupBy("label", "fold").count().collect()
    assert len(rows) == 15 and max(r["count"] for r in rows) - min(r["count"] for r in rows) <= 1
    single = [line for line in plan_of(assigned).splitlines() if "SinglePartition" in line]
    assert len(single) <= 1


def versions(spark, place):
    fs, path = publish._place(spark, place)
    return sorted(s.getPath().getName() for s in fs.listStatus(path))


def test_a_published_table_changes_all_at_once(spark, tmp_path, monkeypatch):
    place = f"file://{tmp_path}/t.parquet"
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, place)
    publish.publish(spark.range(3), place, "one")
    publish.publish(publish.read_published(spark, place).union(spark.range(4)), place, "two")
    assert publish.read_published(spark, place).count() == 7 and publish.pointer(spark, place)["fingerprint"] == "two"

    def stopped(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(publish, "_swap", stopped)
        with pytest.raises(KeyboardInterrupt):
            publish.publish(spark.range(100), place, "three")
    assert publish.read_published(spark, place).count() == 7 and len(versions(spark, place)) == 4
    publish.publish(spark.range(5), place)
    assert publish.read_published(spark, place).count() == 5 and len(versions(spark, place)) == 3


def test_a_second_run_does_nothing(spark, tmp_path):
    from lapsekit.plans.runner import run_datasets

    root = f"file://{tmp_path}"
    spark.range(10).selectExpr("id", "id % 3 as k").write.parquet(f"{root}/in.parquet")
    spark.range(3).selectExpr("id as k", "id * 10 as v").write.parquet(f"{root}/side.parquet")
    sets = [
        {"name": "a", "input": f"{root}/in.parquet", "output": f"{root}/a.parquet", "publish": True, "steps": [{"op": "drop_columns", "cols": "nothing"}]},
        {"name": "b", "input": "a", "output": f"{root}/b.csv", "publish": True, "steps": [{"op": "join", "right": f"{root}/side.parquet", "on": "k"}]},
    ]
    assert run_datasets(spark, sets).unchanged == []
    again = run_datasets(spark, sets)
    assert again.unchanged == ["a", "b"] and again.frames["b"].count() == 10
    spark.range(2).selectExpr("id as k", "id * 7 as v").write.mode("overwrite").parquet(f"{root}/side.parquet")
    third = run_datasets(spark, sets)
    assert third.unchanged == ["a"] and third.frames["b"].where("v is null").count() == 3
    sets[0]["steps"] = []
    assert run_datasets(spark, sets).unchanged == []
    assert run_datasets(spark, [{"name": "c", "input": f"{root}/a.parquet", "steps": []}]).frames["c"].count() == 10


def test_order_keys_are_made_once_per_row(spark):
    from lapsekit.operators.aggregates import groupby_aggregate

    df = spark.range(10).selectExpr("id % 3 as k", "id as a", "id as b", "id as c")
    assert executed(groupby_aggregate(df, "k")).count("xxhash64(") <= 2


def test_quantile_columns_are_cleaned_once(spark):
    from lapsekit.operators import quantiles

    df = spark.range(2000).selectExpr("CAST(id AS DOUBLE) AS x", "CAST(id % 7 AS DOUBLE) AS y")
    probabilities = [0.0, 0.001, 0.25, 1 / 3, 0.5, 0.9, 0.999, 1.0]
    plan = plan_of(quantiles.exact_quantiles(df, ["x", "y"], probabilities, accuracy=100))
    # Bracket tests on the cleaned values, not a NaN test inlined into each one of them: once per column and read.
    assert plan.count("isnan(") <= 2 * 2
