"""Stratified holdouts stay within a row of each class's share when the total share is not whole."""

import pytest
from pyspark.sql import functions as F

from lapsekit.operators import folds


@pytest.mark.parametrize("few", [True, False])
@pytest.mark.parametrize("sizes", [(6, 20), (1, 5), (2, 15), (3, 4, 9, 11)])
def test_each_class_within_a_row_of_its_share(spark, sizes, few):
    labels = [k for k, n in enumerate(sizes) for _ in range(n)]
    df = spark.createDataFrame([(i, y) for i, y in enumerate(labels)], "id long, y int")
    split = folds.holdout_split(df, "y", "id", 0.2, few_classes=few)
    got = {r["y"]: r["t"] for r in split.groupBy("y").agg(F.count_if("is_test").alias("t")).collect()}
    assert sum(got.values()) == -(-len(labels) * 2 // 10)
    assert all(abs(got[k] - 0.2 * n) < 1 for k, n in enumerate(sizes))
