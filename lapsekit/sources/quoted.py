"""Quoted CSV read by many tasks, although quotes may hold line breaks.

A file is read as lines, in as many byte ranges as Spark cuts it into. A line begins either
a record or inside a quoted field, so a whole range is a map from two states to two: where it
leads from "record" and where from "quoted". The maps of a file's ranges are composed by a window
over one row per range, which gives each range its true first state; then each task cuts
its own lines into records. Records that reach over the end of a range are put together from
their parts, and Spark's own CSV parser takes each record apart.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

_RANGE = ["file", "at"]


def ends_quoted(line: str, quoted: bool, sep: str, quote: str = '"') -> bool:
    """Does a quoted field go on after this line? A quote opens a field only at its start; two quotes inside are one."""
    at = 0
    while True:
        if not quoted:
            if line.startswith(quote, at):
                quoted, at = True, at + 1
                continue
        else:
            at = line.find(quote, at)
            if at < 0:
                return True
            at += 1
            if line.startswith(quote, at):
                at += 1
                continue
            quoted = False
        at = line.find(sep, at)
        if at < 0:
            return False
        at += len(sep)


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Each run of lines of one range within a batch."""
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in _RANGE)))
        begin = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[begin]:
                yield keys[begin], batch.slice(begin, i - begin)
                begin = i


def _with_quotes(lines: pa.Array, quote: str) -> list[int]:
    return pc.indices_nonzero(pc.match_substring(lines, quote)).to_pylist()


def _maps(sep: str, quote: str):
    """For each range: the state after it, and whether a record begins in it, from either first state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, begun, done = None, [False, True], [False, False], []
        for found, part in _ranges(batches):
            if found != key:
                if key is not None:
                    done.append((*key, *state, *begun))
                key, state, begun = found, [False, True], [False, False]
            lines, at = part.column("value"), 0
            for i in _with_quotes(lines, quote):
                for s in (0, 1):
                    begun[s] |= not state[s]
                line = lines[i].as_py()
                state, at = [ends_quoted(line, s, sep, quote) for s in state], i + 1
            if at < len(lines):
                begun = [b or not s for b, s in zip(begun, state)]
        if key is not None:
            done.append((*key, *state, *begun))
        columns = list(zip(*done)) or [()] * 6
        kinds = [pa.string(), pa.int64(), *[pa.bool_()] * 4]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=[*_RANGE, "end0", "end1", "begun0", "begun1"]
        )

    return run


def _open_ranges(maps: DataFrame) -> DataFrame:
    """``file, at, opened``: ranges that begin inside a quoted field, and the range in which that record began.

    A map is constant, swaps the states or keeps them. The state before a range is the last
    constant's, swapped as often as swaps follow it; a file begins with a record.
    """
    order = Window.partitionBy("file").orderBy("at")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.sum(F.when(F.col("end0") & ~F.col("end1"), 1).otherwise(0))
    constant = F.when(F.col("end0") == F.col("end1"), F.struct(F.col("end0").cast("int").alias("value"), swaps.over(order).alias("swaps")))
    state = F.coalesce(F.last(constant, ignorenulls=True).over(before)["value"], F.lit(0))
    since = F.coalesce(swaps.over(before), F.lit(0)) - F.coalesce(F.last(constant, ignorenulls=True).over(before)["swaps"], F.lit(0))
    stated = maps.withColumn("quoted", (state + since) % 2 == 1)
    begun = F.when(F.col("quoted"), F.col("begun1")).otherwise(F.col("begun0"))
    opened = F.last(F.when(begun, F.col("at")), ignorenulls=True).over(before)
    return stated.withColumn("opened", opened).where("quoted").select(*_RANGE, "opened")


def _records(sep: str, quote: str, whole: bool):
    """Records that lie within a range, or else the parts of those that do not; a range begins quoted if ``opened`` is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, quoted, owner, held, first = None, False, None, [], True
        out: list[tuple] = []

        def close(text: list[str], broken: bool) -> None:
            if broken != whole:
                out.append((key[0], owner, key[1], "\n".join(text), first and key[1] == 0))

        for found, part in _ranges(batches):
            if found != key:
                if held:
                    close(held, True)
                opened = part.column("opened")[0].as_py()
                key, held, first = found, [], True
                quoted, owner = opened is not None, opened
                entered = quoted
            lines = part.column("value")
            marked = set(_with_quotes(lines, quote))
            for i, line in enumerate(lines.to_pylist()):
                held.append(line)
                if i in marked:
                    quoted = ends_quoted(line, quoted, sep, quote)
                if not quoted:
                    close(held, entered)
                    held, entered, first, owner = [], False, False, key[1]
                elif owner is None:
                    owner = key[1]
            if len(out) >= 4096:
                yield _record_batch(out)
                out = []
        if held:
            close(held, True)
        yield _record_batch(out)

    return run


def _record_batch(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out)) or [()] * 5
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "opened", "at", "record", "first"])


def quoted_records(spark: SparkSession, path: str, sep: str = ",", quote: str = '"') -> DataFrame:
    """``record, first``: the records of CSV files as text, and whether a record is its file's first.

    Lines end with a line feed, with or without a carriage return before it; breaks
    inside quotes stay as they are. Blank records are left out. A quote that is never closed makes the rest of its
    file one record, as it does for any reader.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    maps = lines.mapInArrow(_maps(sep, quote), "file string, at long, end0 boolean, end1 boolean, begun0 boolean, begun1 boolean")
    # One row per byte range that begins inside quotes.
    placed = lines.join(F.broadcast(_open_ranges(maps)), _RANGE, "left")
    schema = "file string, opened long, at long, record string, first boolean"
    parts = placed.mapInArrow(_records(sep, quote, False), schema).groupBy("file", "opened").agg(
        F.array_sort(F.collect_list(F.struct("at", "record"))).alias("parts"), F.max("first").alias("first")
    )
    joined = parts.select(F.array_join(F.col("parts.record"), "\n").alias("record"), "first")
    whole = placed.mapInArrow(_records(sep, quote, True), schema).select("record", "first")
    record: Column = F.regexp_replace("record", "\r$", "")
    every = whole.unionByName(joined).select(record.alias("record"), "first")
    return every.select(F.when(F.col("first"), F.ltrim("record", F.lit("﻿"))).otherwise(F.col("record")).alias("record"), "first").where("record <> ''")


def read_quoted_csv(
    spark: SparkSession, path: str, names: Sequence[str], sep: str = ",", header: bool = True
) -> DataFrame:
    """Text columns ``names`` of CSV files whose quoted fields may hold line breaks, read by many tasks.

    With ``header`` the first record of every file is left out. Fields beyond the names are
    dropped, missing ones are null.
    """
    records = quoted_records(spark, path, sep)
    if header:
        records = records.where(~F.col("first"))
    columns = [f"c{i}" for i in range(len(names))]
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"}
    parsed = F.from_csv("record", F.lit(", ".join(f"{c} string" for c in columns)), options)
    return records.select(parsed.alias("r")).select(*[F.col(f"r.{c}").alias(n) for c, n in zip(columns, names)])
