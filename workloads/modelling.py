"""Splits, models, predictions and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapsekit.operators import folds, metrics as M, models
from lapsekit.session import shared_folder
from workloads.labelling import labelled
from workloads.registry import query, rounded, table


def customer_frame(spark, d):
    """One row per customer, with or without orders, and a few of the customer's numbers."""
    orders = table(spark, d, "orders")
    behaviour = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum("o_totalprice").alias("spent"),
        F.avg("o_totalprice").alias("basket"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"),
    )
    customers = table(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    return customers.join(behaviour, "o_custkey", "left")


def churn_frame(spark, d):
    """The customers with orders and a churn label."""
    label = labelled(spark, d).filter("churned IS NOT NULL").select("o_custkey", "churned").distinct()
    return customer_frame(spark, d).filter("n_orders IS NOT NULL").join(label, "o_custkey")


def embedding_frame(spark, d):
    """Ten classes over the coordinates of each vector."""
    vectors = table(spark, d, "embeddings")
    return vectors.select("vec_id", "label", *[F.col("embedding")[i].alias(f"e{i}") for i in range(64)])


CHURN = {"target": "churned", "id_cols": ["o_custkey"], "random_state": 42, "test_size": 0.2, "cv": {"n_splits": 5}}
LOGREG = {**CHURN, "model": {"name": "logreg"}}
FOREST = {**CHURN, "model": {"name": "rf"}}


@query("kfold_assign")
def kfold_assign(spark, d):
    return folds.kfold_assign(table(spark, d, "labels"), "quality", "doc_id", 5)


_FOLD_SIZES = """WITH p AS (SELECT {label} AS label, row_number() OVER (ORDER BY {label}) - 1 AS place FROM {source})
    SELECT label, (place % 5)::INT AS fold, count(*) AS n FROM p GROUP BY ALL"""


@query("kfold_sizes", _FOLD_SIZES.format(label="o_orderpriority", source="orders"))
def kfold_sizes(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("label"))
    assigned = folds.kfold_assign(orders, "label", "o_orderkey", 5)
    return assigned.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n"))


@query("holdout_split")
def holdout_split(spark, d):
    return folds.holdout_split(table(spark, d, "labels"), "quality", "doc_id", 0.2)


@query(
    "holdout_sizes",
    """WITH k AS (SELECT o_orderstatus AS label, count(*) AS n FROM orders GROUP BY 1),
         w AS (SELECT *, sum(n) OVER () AS total, ceil(sum(n) OVER () * 0.2) AS wanted FROM k),
         b AS (SELECT *, floor(n * wanted / total) AS base, n * wanted / total - floor(n * wanted / total) AS rest FROM w),
         q AS (SELECT *, base + (row_number() OVER (ORDER BY rest DESC, label) <= wanted - sum(base) OVER ())::INT AS quota FROM b)
       SELECT label, n AS n_rows, quota::BIGINT AS n_test FROM q""",
)
def holdout_sizes(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("label"))
    parted = folds.holdout_split(orders, "label", "o_orderkey", 0.2)
    return parted.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("is_test").alias("n_test"))


@query(
    "random_holdout_size",
    "SELECT count(*) AS n_rows, ceil(count(*) * 0.2)::BIGINT AS n_test FROM lineitem",
)
def random_holdout_size(spark, d):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = table(spark, d, "lineitem").select(*keys)
    parted = folds.holdout_split(lines, None, keys, 0.2)
    return parted.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("is_test").alias("n_test"))


# Made-up predictions that are wrong by rule, on every line item.
SCORED = """SELECT (l_returnflag = 'R')::INT AS truth, (l_quantity > 25)::INT AS guess, l_extendedprice AS score,
    l_returnflag AS flag, CASE WHEN l_linenumber % 3 = 0 THEN 'A' ELSE l_returnflag END AS flag_guess,
    l_quantity AS score_a, l_discount AS score_n, l_extendedprice AS score_r FROM {lineitem}"""
DUCK_SCORED = SCORED.replace("{lineitem}", "lineitem")


def _scored(spark, d):
    return spark.sql(SCORED, lineitem=table(spark, d, "lineitem"))


_CLASSES = f"""SELECT c AS class, count(*) FILTER (flag = c AND flag_guess = c) AS tp, count(*) FILTER (flag = c) AS support,
    count(*) FILTER (flag_guess = c) AS predicted
    FROM ({DUCK_SCORED}), (SELECT unnest(['A', 'N', 'R']) AS c) GROUP BY c"""
_RATES = f"""SELECT class, support, tp, coalesce(tp / nullif(predicted, 0)::DOUBLE, 0) AS precision,
    coalesce(tp / nullif(support, 0)::DOUBLE, 0) AS recall,
    coalesce(2 * tp / nullif(support + predicted, 0)::DOUBLE, 0) AS f1 FROM ({_CLASSES})"""


@query(
    "classification_metrics",
    f"""SELECT round(sum(tp) / sum(support)::DOUBLE, 9) AS accuracy, round(avg(f1), 9) AS f1_macro,
               round(avg(precision), 9) AS precision_macro, round(avg(recall), 9) AS recall_macro FROM ({_RATES})""",
)
def classification_metrics(spark, d):
    found = M.classification_metrics(_scored(spark, d), "flag", "flag_guess")
    return rounded(found, found.columns, 9)


@query(
    "binary_metrics",
    f"""WITH t AS (SELECT count(*) FILTER (truth = 1 AND guess = 1) AS tp, count(*) FILTER (truth = 1) AS s,
                          count(*) FILTER (guess = 1) AS p FROM ({DUCK_SCORED}))
        SELECT round(tp / p::DOUBLE, 9) AS precision, round(tp / s::DOUBLE, 9) AS recall,
               round(2 * tp / (s + p)::DOUBLE, 9) AS f1 FROM t""",
)
def binary_metrics(spark, d):
    return rounded(M.binary_metrics(_scored(spark, d), "truth", "guess"), ["precision", "recall", "f1"], 9)


@query(
    "classification_report",
    f"""WITH r AS ({_RATES})
        SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM r
        UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support)::DOUBLE, 9), round(sum(tp) / sum(support)::DOUBLE, 9),
                         round(sum(tp) / sum(support)::DOUBLE, 9), sum(support)::BIGINT FROM r
        UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), sum(support)::BIGINT FROM r
        UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9),
                         round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9),
                         sum(support)::BIGINT FROM r""",
)
def classification_report(spark, d):
    found = M.classification_report(_scored(spark, d), "flag", "flag_guess")
    return rounded(found, ["precision", "recall", "f1"], 9)


@query(
    "confusion_matrix",
    f"""SELECT flag, count(*) FILTER (flag_guess = 'A') AS "predicted_A", count(*) FILTER (flag_guess = 'N') AS "predicted_N",
               count(*) FILTER (flag_guess = 'R') AS "predicted_R" FROM ({DUCK_SCORED}) GROUP BY flag""",
)
def confusion_matrix(spark, d):
    return M.confusion_matrix(_scored(spark, d), "flag", "flag_guess", ["A", "N", "R"])


def _auc_sql(truth: str, score: str, source: str) -> str:
    return f"""SELECT (sum(CASE WHEN t THEN r END) - p * (p + 1) / 2.0::DOUBLE) / (p::DOUBLE * n) AS auc, p AS support
        FROM (SELECT t, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0::DOUBLE AS r,
                     count(*) FILTER (t) OVER () AS p, count(*) FILTER (NOT t) OVER () AS n
              FROM (SELECT {truth} AS t, {score} + 0.0 AS s FROM ({source}))) GROUP BY p, n"""


@query("roc_auc", f"SELECT round(auc, 9) AS roc_auc FROM ({_auc_sql('truth = 1', 'score', DUCK_SCORED)})")
def roc_auc(spark, d):
    return rounded(M.roc_auc(_scored(spark, d), "truth", "score"), ["roc_auc"], 9)


@query("roc_auc_by_ranges", f"SELECT round(auc, 9) AS roc_auc FROM ({_auc_sql('truth = 1', 'score', DUCK_SCORED)})")
def roc_auc_by_ranges(spark, d):
    return rounded(M.roc_auc(_scored(spark, d), "truth", "score", single_task_bytes=0), ["roc_auc"], 9)


@query(
    "roc_auc_ties",
    f"SELECT round(auc, 9) AS roc_auc FROM ({_auc_sql('truth = 1', 'score_a', DUCK_SCORED)})",
)
def roc_auc_ties(spark, d):
    return rounded(M.roc_auc(_scored(spark, d), "truth", "score_a"), ["roc_auc"], 9)


@query(
    "roc_auc_ovr",
    f"""SELECT round(sum(auc * support) / sum(support), 9) AS roc_auc_ovr_weighted FROM (
        {" UNION ALL ".join(_auc_sql(f"flag = '{c}'", f"score_{c.lower()}", DUCK_SCORED) for c in "ANR")})""",
)
def roc_auc_ovr(spark, d):
    found = M.roc_auc_ovr(_scored(spark, d), "flag", {c: f"score_{c.lower()}" for c in "ANR"})
    return rounded(found, ["roc_auc_ovr_weighted"], 9)


@query("fit_logreg")
def fit_logreg(spark, d):
    return models.fit(LOGREG, churn_frame(spark, d)).metrics


@query("fit_rf")
def fit_rf(spark, d):
    return models.fit(FOREST, churn_frame(spark, d)).metrics


@query("fit_logreg_multiclass")
def fit_logreg_multiclass(spark, d):
    config = {"target": "label", "id_cols": ["vec_id"], "model": {"name": "logreg", "params": {"class_weight": "balanced"}}}
    return models.fit(config, embedding_frame(spark, d)).metrics


@query("cv_metrics")
def cv_metrics(spark, d):
    return models.cross_validate(LOGREG, churn_frame(spark, d), parallelism=2)


@query("predictions")
def predictions(spark, d):
    return models.fit(LOGREG, churn_frame(spark, d)).predictions


@query("fit_report")
def fit_report(spark, d):
    return models.fit(LOGREG, churn_frame(spark, d)).report


@query("predict_saved_model")
def predict_saved_model(spark, d):
    """Fit, save, load and score every customer, labelled or not."""
    frame = churn_frame(spark, d)
    place = shared_folder(spark, "model")
    models.save_model(models.fit(LOGREG, frame).model, place)
    return models.predict(models.load_model(place), customer_frame(spark, d), ["o_custkey"])


@query("feature_importance")
def feature_importance(spark, d):
    frame = churn_frame(spark, d)
    fitted = models.fit(FOREST, frame)
    return models.feature_importance(spark, fitted.model, frame)


@query(
    "dry_run",
    """SELECT 'rows' AS item, CAST(count(*) AS VARCHAR) AS value FROM customer
       UNION ALL SELECT 'columns', '5' UNION ALL SELECT 'target', 'c_mktsegment' UNION ALL SELECT 'model', 'rf'
       UNION ALL SELECT 'numeric_features', 'c_nationkey,c_acctbal' UNION ALL SELECT 'categorical_features', 'c_name'
       UNION ALL SELECT 'scoring', CASE WHEN count(DISTINCT c_mktsegment) > 2 THEN 'f1_macro,precision_macro,recall_macro,roc_auc_ovr_weighted'
           ELSE 'f1,precision,recall,roc_auc' END FROM customer""",
)
def dry_run(spark, d):
    """What a fit of the customers' segments would use, over the whole table."""
    config = {"target": "c_mktsegment", "id_cols": ["c_custkey"], "model": {"name": "rf"}}
    found = models.dry_run(config, table(spark, d, "customer"), rows=2**31 - 1)
    return spark.createDataFrame([(k, ",".join(v) if isinstance(v, list) else str(v)) for k, v in found.items()], "item string, value string")
