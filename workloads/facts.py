"""Checkable facts about results that have no single right answer, and rows that clean tables never hold."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapsekit.functions.timing import parse_datetime
from lapsekit.operators import aggregates, casting, columns, features, folds, models, rows, sampling, stats
from lapsekit.operators.derive import add_order_lags
from lapsekit.operators.stats import unpack
from lapsekit.session import shared_folder
from lapsekit.sources import files
from workloads.modelling import CHURN, FOREST, LOGREG, churn_frame, customer_frame
from workloads.registry import query, table

_NULLED = "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate END"


def _dated_orders(spark, d):
    return table(spark, d, "orders").select("o_custkey", "o_orderkey", F.expr(_NULLED).alias("moment"))


_FIRST = f"""SELECT o_custkey, arg_{{pick}}(o_orderkey, (moment IS NULL, coalesce(moment, TIMESTAMP '1900-01-01'), o_orderkey)) AS o_orderkey
    FROM (SELECT o_custkey, o_orderkey, {_NULLED} AS moment FROM orders) GROUP BY 1"""


@query("dedup_first_null_order", _FIRST.format(pick="min"))
def dedup_first_null_order(spark, d):
    return rows.drop_duplicates(_dated_orders(spark, d), "o_custkey", "first", ["moment", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("dedup_last_null_order", _FIRST.format(pick="max"))
def dedup_last_null_order(spark, d):
    return rows.drop_duplicates(_dated_orders(spark, d), "o_custkey", "last", ["moment", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("groupby_first_null_order", _FIRST.format(pick="min"))
def groupby_first_null_order(spark, d):
    return aggregates.groupby_aggregate(_dated_orders(spark, d), "o_custkey", order_by=["moment", "o_orderkey"]).select("o_custkey", "o_orderkey")


_NAN = "CASE WHEN o_orderkey % 5 = 0 THEN CAST('NaN' AS DOUBLE) ELSE o_totalprice END"


@query(
    "nan_is_missing",
    f"""SELECT o_orderpriority, round(sum(x), 4) AS total, round(avg(x), 6) AS mean, min(x) AS least FROM
        (SELECT o_orderpriority, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS x FROM orders) GROUP BY 1""",
)
def nan_is_missing(spark, d):
    df = table(spark, d, "orders").select("o_orderpriority", *[F.expr(_NAN).alias(c) for c in ("total", "mean", "least")])
    got = aggregates.groupby_aggregate(df, "o_orderpriority", ["total"], ["mean"], ["least"], first_for_rest=False)
    return got.select("o_orderpriority", F.round("total", 4).alias("total"), F.round("mean", 6).alias("mean"), "least")


@query("nan_null_counts", "SELECT 'x' AS name, count(*) FILTER (o_orderkey % 5 = 0) AS n_null FROM orders")
def nan_null_counts(spark, d):
    return stats.null_counts(table(spark, d, "orders").select(F.expr(_NAN).alias("x")))


@query(
    "parse_loose_dates",
    """SELECT o_orderkey, make_timestamp(year(o_orderdate), month(o_orderdate), day(o_orderdate), 0, 0, 0) AS short,
        o_orderdate - INTERVAL 3 HOUR AS zoned FROM orders""",
)
def parse_loose_dates(spark, d):
    orders = table(spark, d, "orders")
    short = F.concat_ws("-", F.year("o_orderdate"), F.month("o_orderdate"), F.day("o_orderdate"))
    zoned = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+03:00"))
    return orders.select(
        "o_orderkey", parse_datetime(short, "%Y-%m-%d").alias("short"), parse_datetime(zoned, None, drop_tz=True).alias("zoned")
    )


@query("cast_bool_to_int", "SELECT o_orderkey, CAST(o_orderstatus = 'F' AS BIGINT) AS flag FROM orders")
def cast_bool_to_int(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").alias("flag"))
    return casting.cast_table(df, {"o_orderkey": {"type": "int"}, "flag": {"type": "int"}}, mode="coerce")


@query(
    "cast_strict_errors",
    "SELECT 'o_orderdate' AS named, count(*) FILTER (o_orderkey % 13 = 0) > 0 AS refused FROM orders",
)
def cast_strict_errors(spark, d):
    """A strict cast names the column that does not fit."""
    df = table(spark, d, "orders").select(F.expr("CASE WHEN o_orderkey % 13 = 0 THEN 'bad' ELSE CAST(o_orderdate AS STRING) END").alias("o_orderdate"))
    try:
        casting.cast_table(df, {"o_orderdate": {"type": "datetime"}}, mode="strict")
        said = ""
    except casting.CastError as error:
        said = str(error)
    return spark.createDataFrame([("o_orderdate" if said.startswith("o_orderdate:") else said, bool(said))], "named string, refused boolean")


@query("typed_copy", "SELECT o_orderkey, o_totalprice FROM orders")
def typed_copy(spark, d):
    """The cast copy is read where it exists."""
    place = shared_folder(spark, "typed") + ".parquet"
    files.write_table(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), place)
    return files.read_typed_or_raw(spark, {"path": f"{d}/orders.parquet", "cast": {"output": place}})


@query(
    "gap_matrix_rows",
    """SELECT count(*) AS n, count(*) FILTER (o_orderkey % 3 = 0) AS n_missing FROM orders""",
)
def gap_matrix_rows(spark, d):
    """Rows with a missing date stay in the feature matrix; their gap is NaN."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate", F.expr(_NULLED).alias("at"))
    pipeline, gaps = features.dated_feature_pipeline(["o_totalprice"], ["o_orderpriority"], {"gap": ("o_orderdate", "at")})
    ready = add_order_lags(orders, gaps)
    matrix = pipeline.fit(ready).transform(ready)
    from pyspark.ml.functions import vector_to_array

    last = F.element_at(vector_to_array("features"), -1)
    return matrix.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.isnan(last)).alias("n_missing"))


@query("kfold_facts", "SELECT count(*) AS n, true AS each_once, true AS even, true AS even_in_class FROM labels")
def kfold_facts(spark, d):
    labels = table(spark, d, "labels")
    assigned = folds.kfold_assign(labels, "quality", "doc_id", 5)
    by_fold = assigned.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))
    by_class = assigned.groupBy("quality", "fold").agg(F.count(F.lit(1)).alias("n")).groupBy("quality").agg((F.max("n") - F.min("n")).alias("gap"))
    return assigned.agg(F.count(F.lit(1)).alias("n"), (F.count_distinct("doc_id") == F.count(F.lit(1))).alias("each_once")).withColumns({
        "even": by_fold.agg(F.max("n") - F.min("n") <= 1).scalar(), "even_in_class": by_class.agg(F.max("gap") <= 1).scalar(),
    })


@query("holdout_facts", "SELECT count(*) AS n, CAST(ceil(count(*) * 0.2) AS BIGINT) AS n_test, true AS proportional FROM labels")
def holdout_facts(spark, d):
    split = folds.holdout_split(table(spark, d, "labels"), "quality", "doc_id", 0.2)
    per_class = split.groupBy("quality").agg(F.abs(F.count_if("is_test") - 0.2 * F.count(F.lit(1))).alias("off"))
    return split.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("n_test")).withColumn("proportional", per_class.agg(F.max("off") < 1).scalar())


@query("sample_facts", "SELECT true AS near, true AS stable, true AS nested FROM orders LIMIT 1")
def sample_facts(spark, d):
    """A keyed sample has about the wanted share, does not depend on the partitioning and contains each smaller one."""
    orders = table(spark, d, "orders")
    kept = sampling.sample_fraction(orders, 0.1, keys="o_orderkey")
    again = sampling.sample_fraction(orders.repartition(7), 0.1, keys="o_orderkey")
    less = sampling.sample_fraction(orders, 0.05, keys="o_orderkey")
    mark = lambda df, name: df.agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.hash("o_orderkey").cast("long")).alias("h")).alias(name))
    both = mark(less.join(kept.select("o_orderkey"), "o_orderkey", "left_semi"), "s")
    return orders.agg(F.count(F.lit(1)).alias("all")).select(
        (F.abs(mark(kept, "s").scalar()["n"] / F.col("all") - 0.1) < 0.02).alias("near"),
        (mark(kept, "s").scalar() == mark(again, "s").scalar()).alias("stable"), (both.scalar() == mark(less, "s").scalar()).alias("nested"),
    )


@query("approximate_count_facts", "SELECT 'o_custkey' AS name, true AS near UNION ALL SELECT 'o_totalprice', true")
def approximate_count_facts(spark, d):
    orders = table(spark, d, "orders")
    exact = aggregates.distinct_counts(orders, ["o_custkey", "o_totalprice"])
    near = aggregates.distinct_counts(orders, ["o_custkey", "o_totalprice"], approximate=True).withColumnRenamed("n_distinct", "about")
    return exact.join(near, "name").select("name", (F.abs(F.col("about") / F.col("n_distinct") - 1) <= 0.12).alias("near"))


@query(
    "column_difference",
    """SELECT 'o_orderkey' AS column_name, count(o_orderkey) AS n FROM orders UNION ALL SELECT 'o_totalprice', count(o_totalprice) FROM orders
       UNION ALL SELECT 'made_up', count(*) FROM orders""",
)
def column_difference(spark, d):
    """Columns that only one of two tables has, with their present values."""
    orders = table(spark, d, "orders")
    other = columns.drop_columns(orders, ["o_orderkey", "o_totalprice"]).withColumn("made_up", F.lit(1))
    only_left, only_right = columns.column_difference(orders, other)
    counts = [df.agg(*[F.count(c).alias(c) for c in names]) for df, names in ((orders, only_left), (other, only_right))]
    parts = [unpack(row, [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n")) for c in row.columns]) for row in counts]
    return parts[0].unionByName(parts[1])


_LABELLED = """(SELECT count(*) AS n FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) FILTER (o_orderstatus = 'F') > 0)
    WHERE o_custkey IN (SELECT c_custkey FROM customer))"""


@query("predictions_facts", f"SELECT CAST(ceil(n * 0.2) AS BIGINT) AS n, true AS sums, true AS known FROM {_LABELLED}")
def predictions_facts(spark, d):
    """Held-out rows: as many as asked for, probabilities that add up to 1, only known classes."""
    found = models.fit(LOGREG, churn_frame(spark, d)).predictions
    return found.agg(
        F.count(F.lit(1)).alias("n"), (F.max(F.abs(F.col("proba_0") + F.col("proba_1") - 1)) < 1e-9).alias("sums"),
        F.min((F.col("y_pred").isin(0, 1) & (F.col("y_pred") == (F.col("proba_1") > 0.5).cast("int"))).cast("int")).cast("boolean").alias("known"),
    )


@query("predict_facts", "SELECT count(*) AS n, count(DISTINCT c_custkey) AS n_ids, true AS sums FROM customer")
def predict_facts(spark, d):
    """A saved model scores every customer once, with or without orders."""
    place = shared_folder(spark, "model")
    balanced = {**CHURN, "model": {"name": "logreg", "params": {"class_weight": "balanced"}}}
    models.save_model(models.fit(balanced, churn_frame(spark, d)).model, place)
    scored = models.predict(models.load_model(place), customer_frame(spark, d), ["o_custkey"])
    return scored.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("n_ids"),
        (F.max(F.abs(F.col("proba_0") + F.col("proba_1") - 1)) < 1e-9).alias("sums"),
    )


@query("forest_facts", "SELECT true AS shares, true AS bounded FROM customer LIMIT 1")
def forest_facts(spark, d):
    """Importances are shares of 1 and all metrics lie between 0 and 1."""
    frame = churn_frame(spark, d)
    fitted = models.fit({**FOREST, "model": {"name": "rf", "params": {"n_estimators": 40, "class_weight": "balanced"}}}, frame)
    ranked = models.feature_importance(spark, fitted.model, frame, top=1000)
    bounded = fitted.metrics.agg(F.min(F.col("value").between(0, 1).cast("int")).cast("boolean")).scalar()
    return ranked.agg(((F.abs(F.sum("importance") - 1) < 1e-6) & (F.min("importance") >= 0)).alias("shares")).withColumn("bounded", bounded)
