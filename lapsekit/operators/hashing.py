"""Categories of any number in a vector of fixed width: signed feature hashing.

A category's slot and sign come from a digest of its column and value, so nothing has to be
fetched, numbered or agreed on. Values that share a slot cancel each other on average instead of adding up.
The vocabulary is a table: values that are not in it are all zeros, as in one-hot encoding, and
it tells how many values and rows share a slot.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lapsekit.operators.columns import as_list

WIDTH = 1 << 12


def _place(name: Column, value: Column, width: int) -> tuple[Column, Column]:
    """Slot and sign of a value: eight hexadecimal digits of its digest, and the ninth."""
    digest = F.md5(F.concat_ws("=", name, value))
    slot = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(width)).cast("int")
    sign = F.when(F.conv(F.substring(digest, 9, 1), 16, 10).cast("int") % 2 == 0, 1).otherwise(-1)
    return slot, sign


def hash_vocabulary(df: DataFrame, cols: str | Iterable[str], width: int = WIDTH) -> DataFrame:
    """``name, value, n, slot, sign`` for every present value of the columns; one partial aggregate."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in as_list(cols)])
    counts = df.select(F.explode(pairs).alias("p")).where("p.value is not null").groupBy("p.name", "p.value").agg(F.count("*").alias("n"))
    slot, sign = _place(F.col("name"), F.col("value"), width)
    return counts.select("name", "value", "n", slot.alias("slot"), sign.alias("sign"))


def hashed_slots(df: DataFrame, vocabulary: DataFrame, cols: str | Iterable[str], output: str = "slots") -> DataFrame:
    """Add ``output``: the non-zero slots of a row in order, with the sum of their signs.

    Nulls and values outside the vocabulary add nothing. Each column is one join with its part of the
    vocabulary, broadcast only when it is measured to be small.
    """
    names, result = as_list(cols), df
    for i, c in enumerate(names):
        known = vocabulary.where(F.col("name") == c).select(F.col("value").alias(f"__v{i}"), F.struct("slot", "sign").alias(f"__s{i}"))
        result = result.join(known, F.col(c).cast("string") == F.col(f"__v{i}"), "left").drop(f"__v{i}")
    found = F.array_compact(F.array(*[F.col(f"__s{i}") for i in range(len(names))]))
    slots = F.array_sort(F.array_distinct(F.transform(found, lambda e: e["slot"])))

    def total(slot: Column) -> Column:
        mine = F.filter(found, lambda e: e["slot"] == slot)
        return F.struct(slot.alias("slot"), F.aggregate(mine, F.lit(0), lambda t, e: t + e["sign"]).alias("value"))

    summed = F.filter(F.transform(slots, total), lambda e: e["value"] != 0)
    return result.select(*df.columns, summed.alias(output))


def hashed_vector(
    df: DataFrame, vocabulary: DataFrame, cols: str | Iterable[str], width: int = WIDTH, output: str = "hashed"
) -> DataFrame:
    """Add the sparse vector of :func:`hashed_slots`, for a model's ``vector_features``.

    Spark has no expression that makes sparse vectors, so the slots are handed over in Arrow batches.
    """
    columns = df.columns
    schema = T.StructType([*df.schema.fields, T.StructField(output, VectorUDT())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, slots = batch.num_rows, batch.column("__slots")
            offsets, entries = slots.offsets, slots.values
            parts = [
                pa.array([0] * n, pa.int8()), pa.array([width] * n, pa.int32()),
                pa.ListArray.from_arrays(offsets, entries.field("slot")),
                pa.ListArray.from_arrays(offsets, entries.field("value").cast(pa.float64())),
            ]
            vectors = pa.StructArray.from_arrays(parts, names=["type", "size", "indices", "values"])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], vectors], names=[*columns, output])

    return hashed_slots(df, vocabulary, cols, "__slots").mapInArrow(run, schema)


def collision_report(vocabulary: DataFrame) -> DataFrame:
    """``name, n_values, n_slots, n_shared, shared_rows``: how many values share a slot with a value of any column, and their share of the rows."""
    filled = vocabulary.groupBy("slot").agg(F.count("*").alias("together"))
    joined = vocabulary.join(filled, "slot")
    shared = F.col("together") > 1
    return joined.groupBy("name").agg(
        F.count("*").alias("n_values"), F.count_distinct("slot").alias("n_slots"), F.count_if(shared).alias("n_shared"),
        F.try_divide(F.sum(F.when(shared, F.col("n")).otherwise(0)), F.sum("n")).alias("shared_rows"),
    )
