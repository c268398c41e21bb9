"""Forests keep each row's node between passes."""

from lapsekit.operators import models


def test_forest_caches_node_ids(spark):
    forest = models.build_model("rf")
    assert forest.getCacheNodeIds() and forest.getNumTrees() == 300 and forest.getMaxDepth() == 12
