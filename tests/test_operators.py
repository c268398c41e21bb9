"""Null, tie and edge rules on toy frames."""

import datetime as dt
import unicodedata

import pytest
from pyspark.sql import functions as F

from lapsekit.functions.text import snake_lower
from lapsekit.functions.timing import days_between, hours_between, spark_pattern
from lapsekit.operators import aggregates, casting, columns, derive, features, joins, labels, profiling, rows, stats, validation
from lapsekit.operators.quantiles import exact_quantiles, soft_bounds
from lapsekit.plans.steps import StepError, apply_steps


def values(df, col):
    return [r[col] for r in df.collect()]


def test_snake_lower(spark):
    df = spark.createDataFrame([("New York",), ("Sao  Paulo",), ("a b",), ("a\x1cb",), (None,)], "c string")
    assert values(df.select(snake_lower(F.col("c")).alias("c")), "c") == ["new_york", "sao_paulo", "a_b", "a_b", None]


def test_city_state(spark):
    df = spark.createDataFrame(
        [("paris", "sp"), ("paris", "rj"), ("lyon", "sp"), ("paris", None), (None, "sp")], "city string, state string"
    )
    got = rows.disambiguate_city_state(df, "city", "state")
    assert sorted(map(str, values(got, "city"))) == ["None", "None", "lyon", "paris_rj", "paris_sp"]
    assert rows.disambiguate_city_state(df, "city", "absent").columns == df.columns


def _moments(spark, *pairs):
    read = dt.datetime.fromisoformat
    data = [(i, read(a), read(b)) for i, (a, b) in enumerate(pairs)]
    return spark.createDataFrame(data, "i int, a timestamp_ntz, b timestamp_ntz").orderBy("i")


def test_hours_floor(spark):
    df = _moments(
        spark,
        ("2020-01-01 00:00", "2020-01-01 06:00"),
        ("2020-01-02 12:00", "2020-01-03 12:00"),
        ("2020-01-01 00:01", "2020-01-01 00:00"),
        ("1900-01-01 00:00:00.000001", "2100-01-01 00:00"),
    )
    got = values(df.select("i", hours_between(F.col("a"), F.col("b")).alias("h")).orderBy("i"), "h")
    assert got == [6, 24, -1, 24 * 73049 - 1]


def test_days_floor(spark):
    df = _moments(
        spark,
        ("2020-01-01 00:00", "2020-01-02 23:00"),
        ("2020-01-01 23:00", "2020-01-02 01:00"),
        ("2020-01-01 01:00", "2020-01-01 00:00"),
    )
    assert values(df.select("i", days_between(F.col("a"), F.col("b")).alias("d")).orderBy("i"), "d") == [1, 0, -1]


def test_elapsed_time_ignores_session_zone(spark):
    df = _moments(spark, ("2024-03-09 12:00", "2024-03-10 12:00"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert values(df.select(hours_between(F.col("a"), F.col("b")).alias("h")), "h") == [24]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_quantiles_and_bounds(spark):
    df = spark.createDataFrame([(float(v), None) for v in (0, 1, 2, 3, 100)], "x double, empty double")
    row = soft_bounds(df, ["x"]).first()
    assert (round(row["low"], 6), round(row["high"], 6)) == (-9.568, 105.728)
    assert values(exact_quantiles(df, ["x", "empty"], [0.5]), "name") == ["x"]
    assert exact_quantiles(df, ["empty"], [0.5]).count() == 0


def test_quantiles_of_a_hot_value(spark):
    """One value holds most rows; a coarse sketch still gives exact answers."""
    import numpy as np

    numbers = [7.0] * 4000 + [float(i % 97) for i in range(3000)] + [float("nan")] * 5
    df = spark.createDataFrame([(v,) for v in numbers], "x double").repartition(5)
    probabilities = [0.0, 0.05, 0.3, 0.5, 0.77, 0.99, 1.0]
    got = exact_quantiles(df, ["x"], probabilities, accuracy=100).first()["quantiles"]
    assert np.allclose(got, np.quantile(np.array(numbers[:7000]), probabilities))


def test_medians(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,), (None,)], "x double")
    assert sorted(values(features.impute_median(df, "x"), "x")) == [1.0, 2.0, 3.0, 4.0, 10.0]


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "s string")
    assert features.most_frequent(df, ["s"]).first()["value"] == "a"


def test_dummies(spark):
    got = features.get_dummies(spark.createDataFrame([(1, "a"), (2, None)], "i int, s string"), "s")
    assert got.columns == ["i", "s_a"] and sorted(map(tuple, got.collect())) == [(1, 1), (2, 0)]


def test_group_sum_and_first(spark):
    df = spark.createDataFrame(
        [(1, 1, None, None), (1, 2, None, "b"), (1, 3, None, "a"), (None, 4, 2.0, "z")],
        "k int, pos int, x double, s string",
    )
    got = {r["k"]: r for r in aggregates.groupby_aggregate(df, "k", sum_cols=["x"], order_by="pos").collect()}
    assert (got[1]["x"], got[1]["s"], got[1]["pos"]) == (0.0, "b", 1)
    assert got[None]["x"] == 2.0
    stable = aggregates.groupby_aggregate(df, "k", ["x"])
    again = aggregates.groupby_aggregate(df.repartition(7), "k", ["x"])
    assert sorted(stable.collect(), key=str) == sorted(again.collect(), key=str)


def test_later_aggregate_wins(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0)], "k int, x double")
    assert aggregates.groupby_aggregate(df, "k", ["x"], ["x"]).first()["x"] == 2.0
    assert aggregates.groupby_aggregate(df, "k", ["x"], ["x"], ["x"]).first()["x"] == 1.0


def test_null_keys_match(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], "k string, x int")
    right = spark.createDataFrame([("a", 10), (None, 20), ("d", 40)], "k string, y int")
    got = sorted(map(tuple, joins.join(left, right, "k", "outer").collect()), key=str)
    assert got == sorted([("a", 1, 10), (None, 2, 20), ("c", 3, None), ("d", None, 40)], key=str)
    assert joins.join(left, right, "k", "inner").count() == 2


def test_join_errors(spark):
    left = spark.createDataFrame([(1, 2, 3)], "k int, v int, v_r int")
    right = spark.createDataFrame([(1, 5), (1, 6)], "k int, v int")
    with pytest.raises(ValueError, match="repeat column names"):
        joins.join(left, right, "k")
    with pytest.raises(joins.JoinKeyError):
        joins.join(left.drop("v_r"), right, "k", validate="m:1")
    with pytest.raises(ValueError, match="how"):
        joins.join(left, right, "k", how="cross")


def test_duplicates_keep_none(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, "e")], "k int, s string")
    assert values(rows.drop_duplicates(df, "k", keep=False), "s") == ["e"]
    assert rows.drop_duplicates(df, "k", "last", "s").count() == 3
    with pytest.raises(ValueError):
        rows.drop_duplicates(df, "k", keep="middle")


def test_columns(spark):
    df = spark.createDataFrame([(1, "a", True, 2.0)], "i int, s string, b boolean, d double")
    assert columns.feature_types(df, "i") == (["d"], ["s", "b"])
    assert columns.select_columns(df, include=["d", "x", "i"]).columns == ["d", "i"]
    with pytest.raises(ValueError):
        columns.select_columns(df, include="i", exclude="s")
    assert columns.dropna_columns(df.limit(0), min_missing_ratio=0.0).columns == df.columns
    assert columns.column_difference(df, df.drop("s").withColumn("z", F.lit(1))) == (["s"], ["z"])


LABEL_ROWS = [(1, "2020-01-01", "d"), (1, "2020-02-01", "d"), (2, "2020-01-15", "d"), (3, "bad", "d"), (4, "2020-01-01", "x"), (None, "2020-01-01", "d")]


def test_label_rules(spark):
    df = spark.createDataFrame(LABEL_ROWS, "c int, ts string, st string")
    got = labels.create_churn_label(df, "c", "ts", horizon_days=30, filter_status_col="st", keep_statuses=["d"])
    found = {r["c"]: r["churned"] for r in got.collect()}
    assert found == {1: 0, 2: 0, 3: 0, 4: None, None: None} and got.count() == len(LABEL_ROWS)
    shorter = labels.create_churn_label(df, "c", "ts", horizon_days=10, filter_status_col=None)
    assert {r["c"]: r["churned"] for r in shorter.collect()}[2] == 1


def test_label_existing_target(spark):
    df = spark.createDataFrame([(1, "2020-01-01", 9)], "c int, ts string, churned int")
    options = {"filter_status_col": None}
    assert labels.create_churn_label(df, "c", "ts", **options).first()["churned"] == 9
    forced = labels.create_churn_label(df, "c", "ts", force=True, **options)
    assert forced.columns.count("churned") == 1 and forced.first()["churned"] == 0
    with pytest.raises(ValueError, match="status"):
        labels.create_churn_label(df.drop("churned"), "c", "ts")


def test_int_cast(spark):
    df = spark.createDataFrame([("1",), ("x",), ("1.5",), (" 7 ",), ("9007199254740993",), ("1d",)], "v string")
    got = values(casting.cast_table(df, {"v": {"type": "int"}}, mode="coerce"), "v")
    assert got == [1, None, None, 7, 9007199254740993, None]
    with pytest.raises(casting.CastError, match="v: 3 values"):
        casting.cast_table(df, {"v": {"type": "int"}})
    with pytest.raises(casting.CastError):
        casting.cast_table(df, {"v": {"type": "int", "nullable": False}}, mode="coerce")
    with pytest.raises(casting.CastError):
        casting.cast_table(df.filter("v = '1.5'"), {"v": {"type": "int", "on_fraction": "error"}}, mode="coerce")


def test_bool_cast(spark):
    df = spark.createDataFrame([(" TRUE ",), ("no",), ("t",), (None,)], "v string")
    assert values(casting.cast_table(df, {"v": {"type": "bool"}}, mode="coerce"), "v") == [True, False, None, None]
    with pytest.raises(casting.CastError):
        casting.cast_table(df.filter("v IS NULL"), {"v": {"type": "bool"}})


def test_column_check(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    with pytest.raises(casting.CastError, match="unknown"):
        casting.cast_table(df, {"a": {"type": "int"}})
    with pytest.raises(casting.CastError, match="missing"):
        casting.cast_table(df, {"z": {"type": "int"}}, keep_unknown=True)
    kept = casting.cast_table(df, {"a": {"type": "int"}}, keep_unknown=True)
    assert kept.dtypes == [("a", "bigint"), ("b", "string")]


def test_pattern():
    assert spark_pattern("%Y-%m-%dT%H:%M:%S.%f%z") == "yyyy-M-d'T'H:m:s.SSSSSS[XXX][XX]"
    assert spark_pattern("%Y%m%d %H%M") == "yyyyMMdd HHmm"
    with pytest.raises(ValueError):
        spark_pattern("%Q")


def test_datetime_needs_its_fraction(spark):
    df = spark.createDataFrame([("2020-01-01 00:00:00.5",), ("2020-01-01 00:00:00",)], "v string")
    spec = {"v": {"type": "datetime", "format": "%Y-%m-%d %H:%M:%S.%f"}}
    assert values(casting.cast_table(df, spec, mode="coerce"), "v") == [dt.datetime(2020, 1, 1, 0, 0, 0, 500000), None]


def test_value_share(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",), ("a",)], "s string")
    got = aggregates.value_counts(df, "s", normalize=True).collect()
    assert [(r["s"], round(r["share"], 6)) for r in got] == [("a", 0.666667), ("b", 0.333333)]


def test_group_by_features_errors(spark):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    with pytest.raises(ValueError, match="numeric"):
        derive.group_by_features(df, {"f": ["s"]})
    with pytest.raises(ValueError):
        derive.group_by_features(df, {"f": ["i"]}, ["sum", "max"])
    with pytest.raises(ValueError):
        derive.group_by_features(df, {"f": ["i"]}, {"g": "sum"})
    with pytest.raises(TypeError):
        derive.group_by_features(df, {"f": ["i"]}, 3)
    assert derive.group_by_features(df, {"f": "i"}, keep_original=True).columns == ["i", "s", "f"]
    assert derive.group_by_features(df, {"f": "i"}).columns == ["s", "f"]


def test_histogram_lists_empty_bins_and_constants(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (10.0,), (None,)], "x double")
    assert [r["n"] for r in stats.histogram(df, "x", 5).orderBy("bin").collect()] == [2, 0, 0, 0, 1]
    same = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert sum(r["n"] for r in stats.histogram(same, "x", 4).collect()) == 2


def test_profile_many_values_are_not_listed(spark):
    df = spark.range(500).select(
        F.col("id").cast("string").alias("wide"), (F.col("id") % 50).cast("string").alias("fifty"),
        (F.col("id") % 51).cast("string").alias("fiftyone"), (F.col("id") % 2 == 0).alias("flag"),
        F.lit(None).cast("string").alias("nothing"),
    )
    got = {r["name"]: r for r in profiling.profile(df).collect()}
    assert got["wide"]["categories"] is None and got["fiftyone"]["categories"] is None
    assert len(got["fifty"]["categories"]) == 50 and got["flag"]["categories"] == ["false", "true"]
    assert got["nothing"]["dtype"] == "empty"


def test_validation_thresholds_and_types(spark):
    df = spark.createDataFrame([("1",), ("2",)], "x string")
    suite = {"columns": {"x": {"dtype": "integer", "null_rate": 0.0, "num_bounds": {"low": 0, "high": 1}}}}
    found = validation.validate(df, suite)
    assert values(found.filter("check = 'type'"), "passed") == [True]
    validation.assert_valid(found)
    with pytest.raises(validation.ValidationError):
        validation.assert_valid(validation.validate(df, suite, strict_types=True))
    pick = validation.resolve_threshold
    assert pick("oob_ratio", "x", None, None) == 0.01
    assert pick("oob_ratio", "x", None, {"oob_ratio": 0.2}) == 0.2
    assert pick("oob_ratio", "x", {"thresholds": {"oob_ratio": 0.3}}, {"oob_ratio": 0.2}) == 0.3
    assert pick("oob_ratio", "x", {"columns": {"x": {"oob_ratio": 0.4}}, "thresholds": {"oob_ratio": 0.3}}, {}) == 0.4


def test_step_errors(spark):
    df = spark.range(3)
    for steps, text in (
        ([{"cols": []}], "step 1"),
        ([{"op": "drop_columns", "cols": []}, {"op": "nope"}], "step 2"),
        ([{"op": "drop_columns", "bad": 1}], "step 1"),
        ([{"op": "join", "right": "t", "on": "id"}], "resolves"),
    ):
        with pytest.raises(StepError, match=text):
            apply_steps(df, steps)


def test_accents_go_and_letters_stay(spark):
    from lapsekit.functions.text import strip_accents

    words = ["São Paulo", "plain", "Ŝ̌z", "ﬁ", "日本", "ñandú", "", None, "हिन्दी"]
    df = spark.createDataFrame([(w,) for w in words], "c string")
    plain = [None if w is None else "".join(c for c in unicodedata.normalize("NFKD", w) if not unicodedata.combining(c)) for w in words]
    assert values(df.select(strip_accents(F.col("c")).alias("c")), "c") == plain
