"""Rows are never shuffled by the city alone, whose few values would each fill one task."""

from lapsekit.operators import rows


def test_no_city_keyed_shuffle_when_no_city_is_ambiguous(spark):
    df = spark.range(4000).selectExpr("concat('c', id % 3) AS city", "concat('s', id % 3) AS state", "id")
    # Planned as for large inputs: sizes are only known once the adaptive planner has measured them.
    settings = {"spark.sql.autoBroadcastJoinThreshold": "1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = rows.disambiguate_city_state(df, "city", "state")
        assert sorted(r.city for r in got.select("city").distinct().collect()) == ["c0", "c1", "c2"]
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
