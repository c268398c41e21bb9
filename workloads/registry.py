"""Where queries and their SQL counterparts are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is what another engine should answer on the same tables."""

    def register(func: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = func
        if sql is not None:
            ORACLES[name] = sql
        return func

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Round for comparison with an engine that adds doubles in another order."""
    return df.withColumns({c: F.round(c, digits) for c in cols})
