"""The dated feature matrix scales quantities by all lines, as its SQL's s does, not by the joined ones."""

import datetime

from workloads.preparing import dated_feature_matrix


def test_scaling_is_learned_from_all_lines(spark, tmp_path):
    day = datetime.date(2020, 1, 1)
    lines = [(1, 1, 10, 1.0, "A", day), (2, 1, 20, 2.0, "N", day), (3, 1, 30, 3.0, "R", day)]
    spark.createDataFrame(
        lines, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_returnflag string, l_shipdate date"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    # Line 3 has no order: it is left out of the result but not out of the mean and deviation.
    spark.createDataFrame([(1, day), (2, day)], "o_orderkey long, o_orderdate date").write.parquet(f"{tmp_path}/orders.parquet")
    got = {r.l_orderkey: r for r in dated_feature_matrix(spark, str(tmp_path)).collect()}
    assert sorted(got) == [1, 2]
    assert got[1].quantity == -1.22474 and got[2].quantity == 0.0
    assert (got[1].a, got[1].n, got[1].r) == (1.0, 0.0, 0.0) and (got[2].a, got[2].n, got[2].r) == (0.0, 1.0, 0.0)
