"""Session settings the library is written for."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# Every entry is an ordinary Spark setting; a caller may override any of them.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs the next operator a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "lapsekit", master: str | None = None, **settings: str) -> SparkSession:
    """Start (or fetch) a session with :data:`RECOMMENDED` applied first."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path in a folder that the driver and all executors can reach.

    The folder is the one named by ``spark.checkpoint.dir``; where that is unset it
    is the session's warehouse, but not a local one on a cluster. A machine-local folder is never made up here.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir", None)
        one_machine = re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master)
        if not base or (not one_machine and base.startswith(("file:", "/"))):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    For frames that are used many times (a training table, scored rows): the work
    behind them is done once, the plan starts from files again, and a lost
    executor costs no recomputation. The files stay until the folder is cleaned.
    """
    place = shared_folder(df.sparkSession, purpose) + ".parquet"
    df.write.parquet(place)
    return df.sparkSession.read.parquet(place)
