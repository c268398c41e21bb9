"""Where this folder's queries and their SQL counterparts are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is what another engine should answer on the same tables."""

    def register(func: Query) -> Query:
        QUERIES[name] = func
        if sql is not None:
            ORACLES[name] = sql
        return func

    return register


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let Arrow batches hold this many rows: whole texts are long, and a task holds a few batches at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
