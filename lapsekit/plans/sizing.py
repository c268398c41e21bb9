"""Choosing a plan by the size Catalyst already knows.

The optimiser keeps a byte estimate for every plan. It starts from file sizes,
which are compressed, so the limits below leave room for data several times
larger in memory. Where no estimate is available the answer is "large", which
always has a distributed plan. Joins are not decided here: the adaptive planner measures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Below this a broadcast copy per executor is cheap.
BROADCAST_BYTES = 32 * 1024 * 1024
# Below this one task may sort a whole column.
SINGLE_TASK_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimiser's size estimate of a frame, or ``None`` if it cannot be had."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None


def fits(df: DataFrame, limit: int) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= limit
