"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lapsekit.session import materialize


def _to_smallest(edges: DataFrame, keep_own: bool) -> DataFrame:
    """Point every neighbour of ``u`` at the smallest one; groups are minima, so hot nodes are pre-aggregated."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u").select("u", "v", F.least("m", "u").alias("m"))
    out = joined.where("v > u" if keep_own else "v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not keep_own:
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component`` for each node of an edge: the smallest node it is connected with.

    Large-star and small-star steps are repeated until the edges are stars; every
    round is written to the shared folder, so lost executors cost one round at most.
    Null ends and loops are ignored; no edges give an empty table.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now, seen = materialize(pairs.where("u is not null and v is not null and u <> v").distinct(), "edges"), None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_smallest(both, keep_own=True)
        now = materialize(_to_smallest(large, keep_own=False), "edges")
        state = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if state == seen:
            break
        seen = state
    stars = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("id"), "component").distinct())


def named(nodes: DataFrame, *keys: str) -> DataFrame:
    """Add ``id``, a hash of the keys that is different for each node; ``keys`` must identify a node.

    Where two nodes share a hash (once in 40 tables of a billion nodes) another salt is taken.
    """
    salt = 0
    while True:
        out = nodes.withColumn("id", F.xxhash64(F.lit(salt), *keys))
        total, distinct = out.select("id").agg(F.count("*"), F.count_distinct("id")).first()
        if total == distinct:
            return out
        salt += 1


def smallest_ids(lows: DataFrame, members: DataFrame) -> DataFrame:
    """``component, class``: the smallest id in each component of ``lows(component, low)``.

    ``members`` holds an id of the caller and its component, in this order. An id in several components joins them.
    """
    least = lows.groupBy("component").agg(F.min("low").alias("low"))
    member, component = members.columns
    spread = members.groupBy(member).agg(F.min(component).alias("a"), F.max(component).alias("z")).where("a <> z")
    spread = materialize(spread.select(member, "a"), "spread")
    if spread.isEmpty():
        return least.withColumnRenamed("low", "class")
    links = members.join(spread, member).select("a", F.col(component).alias("b")).distinct()
    joined = components(links).select(F.col("id").alias("component"), F.col("component").alias("whole"))
    both = least.join(joined, "component", "left").withColumn("whole", F.coalesce("whole", "component"))
    return both.join(both.groupBy("whole").agg(F.min("low").alias("class")), "whole").select("component", "class")
