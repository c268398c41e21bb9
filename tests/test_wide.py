"""Mergeable profiles, long category lists, hashed categories."""

import hashlib

import pytest
from pyspark.sql import functions as F

from lapsekit.operators import folds, hashing, models, ranks, sketches, stats, validation
from lapsekit.operators.profiling import profile, suite_from_profile

COLUMNS = "x double, k int, s string, d date, b boolean"


def plain(df):
    return {r["name"]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def mixed(spark):
    return spark.range(900).select(
        F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 10 == 1, F.lit(float("nan"))).otherwise(F.col("id") * 1.5).alias("x"),
        (F.col("id") % 7).cast("int").alias("k"), F.concat(F.lit("v"), F.col("id") % 30).alias("s"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") % 40).cast("int")).alias("d"), (F.col("id") % 2 == 0).alias("b"),
    )


def test_merged_parts_give_the_whole_profile(spark, mixed):
    parts = [sketches.sketch_profile(mixed.where(F.col("k").isin(*ks))) for ks in ([0, 1], [2], [3, 4, 5, 6])]
    parts.append(sketches.sketch_profile(spark.createDataFrame([], COLUMNS)))
    want = plain(profile(mixed))
    for merged in (
        sketches.merge_profiles(*parts),
        sketches.merge_profiles(sketches.merge_profiles(parts[3], parts[1]), sketches.merge_profiles(parts[2], parts[0])),
    ):
        got = plain(sketches.profile_from_sketches(merged))
        assert got.keys() == want.keys()
        for name, row in want.items():
            # A sketch that has not filled up is exact, but does not interpolate.
            near = {k: pytest.approx(row[k], abs=6) if row[k] is not None else None for k in ("low", "high")}
            assert {k: v for k, v in got[name].items() if k != "n_values"} == row | near
        assert got["s"]["n_values"] == pytest.approx(30, abs=2)
    errors = sketches.quantile_rank_errors(mixed, sketches.merge_profiles(*parts), [0.0, 0.3, 1.0])
    assert errors.count() == 6 and errors.agg(F.max("error")).first()[0] <= 2 * sketches.RANK_ERROR


def test_merging_parts_that_differ(spark):
    a = spark.createDataFrame([(i, f"a{i}", 1.0) for i in range(40)], "id int, s string, only_a double")
    b = spark.createDataFrame([(f"{i}", f"b{i}") for i in range(40)], "id string, s string")
    got = plain(sketches.profile_from_sketches(sketches.merge_profiles(sketches.sketch_profile(a), sketches.sketch_profile(b))))
    assert got["id"]["dtype"] == "mixed" and got["id"]["low"] is None
    assert got["s"]["categories"] is None and got["s"]["row_count"] == 80
    assert got["only_a"]["row_count"] == 40
    nothing = sketches.sketch_profile(spark.createDataFrame([], COLUMNS))
    assert all(r["dtype"] == "empty" and r["low"] is None for r in plain(sketches.profile_from_sketches(nothing)).values())
    with pytest.raises(ValueError):
        sketches.merge_profiles()


def test_profiles_of_several_tables_merge_by_day(spark, mixed):
    days = [sketches.sketch_many({"t": mixed.where(F.col("k") == k), "u": mixed.select("s")}) for k in (1, 2)]
    merged = sketches.merge_many(*days)
    rows = {(r["dataset"], r["name"]): r["rows"] for r in merged.collect()}
    assert rows["t", "x"] == mixed.where("k in (1, 2)").count() and rows["u", "s"] == 1800
    suite = suite_from_profile(sketches.profile_from_sketches(merged.where("dataset = 't'").drop("dataset")))
    assert validation.failures(validation.validate(mixed.where("k in (1, 2)"), suite)).count() == 0


def test_long_category_baselines(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", None), (None, 2), ("c", 3)], "s string, n int")
    known = spark.createDataFrame([("s", "a"), ("s", "b"), ("s", "b"), ("s", None), ("n", "1"), ("other", "c")], "name string, value string")
    fresh = validation.novel_values(df, known, ["s", "n"])
    assert sorted(map(tuple, fresh.collect())) == [("n", "2", 1), ("n", "3", 1), ("s", "c", 2)]
    found = validation.validate_long_categories(df, known, ["s", "n"], {"columns": {"s": {"new_cat_ratio": 0.5}}})
    rows = sorted((r["name"], r["observed"], r["passed"], r["detail"]) for r in found.collect())
    assert rows == [("n", 0.4, False, "1 known"), ("s", 0.4, True, "2 known")]
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "InSet" not in plan and " IN (" not in plan
    assert [tuple(r) for r in validation.validate_long_categories(df.limit(0), known, "s").select("observed", "passed").collect()] == [(0.0, True)]
    assert validation.validate_long_categories(df, known.limit(0), "s").first()["observed"] == 0.8
    several = validation.validate_many(spark, {"t": {"df": df, "suite": {"columns": {}}, "strict_structure": False, "known": known, "known_cols": ["s"]}})
    assert [r["name"] for r in several.where("check = 'categories'").collect()] == ["s"]


def slots_of(name, value, width):
    digest = hashlib.md5(f"{name}={value}".encode()).hexdigest()
    return int(digest[:8], 16) % width, 1 if int(digest[8], 16) % 2 == 0 else -1


def test_hashed_slots_match_plain_python(spark):
    values = [(i, f"é{i % 60}", i % 13, None if i % 5 else "z") for i in range(300)]
    df = spark.createDataFrame(values, "id int, a string, b int, c string")
    known = hashing.hash_vocabulary(df.where("id < 40"), ["a", "b", "c"], 16)
    seen = {(n, str(v)) for i, *row in values if i < 40 for n, v in zip("abc", row) if v is not None}
    want = []
    for i, *row in values:
        total = {}
        for n, v in zip("abc", row):
            if (n, str(v)) in seen:
                slot, sign = slots_of(n, v, 16)
                total[slot] = total.get(slot, 0) + sign
        want.append((i, [(s, t) for s, t in sorted(total.items()) if t]))
    got = hashing.hashed_slots(df, known, ["a", "b", "c"])
    assert sorted((r["id"], [tuple(e) for e in r["slots"]]) for r in got.collect()) == want
    report = {r["name"]: r for r in hashing.collision_report(known).collect()}
    places = [slots_of(n, v, 16)[0] for n, v in seen]
    assert report["a"]["n_shared"] == sum(places.count(slots_of("a", v, 16)[0]) > 1 for n, v in seen if n == "a")
    assert hashing.hashed_slots(df, known.limit(0), ["a"]).where("size(slots) > 0").count() == 0


def test_a_model_learns_from_hashed_categories(spark):
    df = spark.range(600).select("id", F.concat(F.lit("u"), F.col("id") % 150).alias("who"), ((F.col("id") % 150) % 2).alias("y"))
    known = hashing.hash_vocabulary(df, "who", 1 << 14)
    ready = hashing.hashed_vector(df, known, "who", 1 << 14).drop("who").withColumn("one", F.lit(1.0))
    baseline = models.fit({"target": "y", "id_cols": ["id"], "numeric_features": ["one"], "vector_features": ["hashed"], "model": {"name": "logreg"}}, ready)
    scored = models.predict(baseline.model, ready, ["id"], keep=["y"])
    assert scored.where("cast(y as string) = prediction").count() > 570


def test_tiles_of_columns_correlate_like_pairs(spark):
    made = [(float(i), 1e9 + i % 7, None if i % 3 else i * i * 1.0, 4.0, float("nan") if i % 4 == 0 else -i / 3, None) for i in range(200)]
    df = spark.createDataFrame(made, "a double, b double, c double, d double, e double, f double")
    pairs = {(r[0], r[1]): r[2] for r in stats.correlation_pairs(df).collect()}
    for tile in (2, 4, 100):
        tiles = {(r[0], r[1]): r[2] for r in stats.correlation_tiles(df, tile=tile).collect()}
        assert tiles.keys() == pairs.keys()
        for key, value in pairs.items():
            if "d" in key or "f" in key:
                assert tiles[key] is None
            else:
                assert tiles[key] == pytest.approx(value, abs=1e-6)
    assert stats.correlation_tiles(df.limit(0)).where("corr is not null").count() == 0
    assert stats.correlation_tiles(df, ["a"]).count() == 0


def test_running_totals_over_texts(spark):
    import random

    rng = random.Random(1)
    words = {f"user_{rng.randrange(10**6)}" for _ in range(400)} | {"", "user_", "übung", "user_é", "user_12345678", "user_123456789"}
    made = [(w, rng.randrange(9)) for w in words]
    df = spark.createDataFrame(made, "w string, n long")
    want, total = [], 0
    for w, n in sorted(made, key=lambda t: t[0].encode()):
        want.append((w, n, total))
        total += n
    for few in (True, False):
        assert sorted(map(tuple, ranks.text_running_before(df, "w", ["n"], ranges=40, one_task=few).collect())) == sorted(want)
    only = df.where("w like 'user_1%'")
    assert ranks.text_running_before(only, "w", ["n"], ranges=5).count() == only.count()
    assert ranks.text_running_before(df.limit(0), "w", ["n"]).count() == 0


@pytest.mark.parametrize("classes", [1, 3, 150, 600])
def test_splits_of_many_classes_are_those_of_few(spark, classes):
    df = spark.range(600).select("id", F.when(F.col("id") % classes == 5, None).otherwise(F.concat(F.lit("c"), F.pmod(F.xxhash64("id"), F.lit(classes)))).alias("y"))
    for few, many in (
        (folds.kfold_assign(df, "y", "id", 7, few_classes=True), folds.kfold_assign(df, "y", "id", 7, few_classes=False)),
        (folds.holdout_split(df, "y", "id", 0.3, few_classes=True), folds.holdout_split(df, "y", "id", 0.3, few_classes=False)),
    ):
        assert sorted(map(tuple, many.collect()), key=repr) == sorted(map(tuple, few.collect()), key=repr)
    assert folds.holdout_split(df, "y", "id", 0.3, few_classes=False).where("is_test").count() == 180


def test_no_task_holds_a_row_for_every_class(spark):
    df = spark.range(5000).select("id", F.concat(F.lit("label"), F.col("id")).alias("y"))
    split = folds.holdout_split(df, "y", "id", 0.3, range_bits=2, few_classes=False)
    split.count()
    alone = []

    def walk(plan):
        name = plan.nodeName()
        if name == "Exchange" and "SinglePartition" in plan.toString().splitlines()[0]:
            alone.append(plan.metrics().get("shuffleRecordsWritten").get().value())
        children = [plan.executedPlan()] if name == "AdaptiveSparkPlan" else [plan.plan()] if "QueryStage" in name else []
        inner = plan.children()
        children += [inner.apply(i) for i in range(inner.size())]
        for child in children:
            walk(child)

    rows = split._jdf.queryExecution()
    split._jdf.queryExecution().executedPlan().executeCollect()
    walk(rows.executedPlan())
    assert alone and max(alone) <= 512 * 8
