"""Tables that change all at once.

A published table is a folder of versions and a small pointer file. A new version is
written beside the old one; only when it is complete does the pointer move, by an
overwriting rename, which file systems with atomic renames do in one step. Readers follow the pointer, so a run
that stops anywhere leaves them the old version. The pointer also holds a fingerprint of what the
version was made from, by which a run sees that it has nothing to do.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from lapsekit.sources.files import _is_parquet, read_table, write_table

POINTER = "CURRENT.json"
# Versions that stay beside the current one, for readers that are still at it.
KEPT = 1


def _place(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def pointer(spark: SparkSession, path: str) -> dict[str, Any] | None:
    """What the pointer of a published table says (``version``, ``earlier``, ``fingerprint``), or ``None`` where nothing is published."""
    fs, place = _place(spark, f"{path.rstrip('/')}/{POINTER}")
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _swap(spark: SparkSession, path: str, content: dict[str, Any]) -> None:
    fs, aside = _place(spark, f"{path}/.{POINTER}-{uuid.uuid4().hex}")
    out = fs.create(aside)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    target = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}"))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(aside), target, options)


def publish(df: DataFrame, path: str, fingerprint: str | None = None, sep: str = ",", kept: int = KEPT) -> None:
    """Write a frame as the next version of the table at ``path`` and point to it.

    The frame may read the table itself. Versions before the last ``kept`` are removed
    after the swap; what a broken run has left beside them goes with the next one that succeeds.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    before = pointer(spark, path)
    version = f"{uuid.uuid4().hex}{'.parquet' if _is_parquet(path) else '.csv'}"
    write_table(df, f"{path}/{version}", sep)
    earlier = [before["version"], *before["earlier"]][:kept] if before else []
    _swap(spark, path, {"version": version, "earlier": earlier, "fingerprint": fingerprint})
    fs, place = _place(spark, path)
    for status in fs.listStatus(place):
        name = status.getPath().getName()
        if name != POINTER and name not in (version, *earlier):
            fs.delete(status.getPath(), True)


def read_published(spark: SparkSession, path: str, sep: str = ",", multiline: bool = True) -> DataFrame:
    """The current version of a published table."""
    found = pointer(spark, path)
    if found is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return read_table(spark, f"{path.rstrip('/')}/{found['version']}", sep, multiline=multiline)


def input_state(spark: SparkSession, path: str) -> str:
    """What tells one state of an input from another: a published table's version; else size, number of files and times
    of the file or folder, without listing the files on the driver."""
    found = pointer(spark, path)
    if found is not None:
        return found["version"]
    fs, place = _place(spark, path)
    status, inside = fs.getFileStatus(place), fs.getContentSummary(place)
    done = spark._jvm.org.apache.hadoop.fs.Path(place, "_SUCCESS")
    times = [status.getModificationTime()]
    if status.isDirectory() and fs.exists(done):
        times.append(fs.getFileStatus(done).getModificationTime())
    return json.dumps([str(status.getPath().toString()), inside.getLength(), inside.getFileCount(), times])


def fingerprint(parts: Iterable[Any]) -> str:
    """A digest of anything JSON can spell: input states, steps, parameters."""
    return hashlib.sha256(json.dumps(list(parts), sort_keys=True, default=str).encode()).hexdigest()
