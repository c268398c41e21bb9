"""A fixed-size bitmap of ids that keeps most rows out of a shuffle.

Joins with a list of ids would shuffle every text. A bitmap of the hashed ids has the
same size however many there are; rows outside it cannot match, so only the others
take part in the exact join. With very many ids more rows take part; the result
stays the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lapsekit.llm.texts import mix

BITS = 26


def _place(ids: np.ndarray, bits: int) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def _marks(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _place(batch.column(0).drop_null().to_numpy(), bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at >> 6), pa.array(np.int64(1) << (at & 63))], names=["word", "mask"]
            )

    return run


def bitmap(ids: DataFrame, bits: int = BITS) -> np.ndarray:
    """The bitmap of a one-column frame of long ids; ``2 ** (bits - 6)`` numbers at most reach the driver."""
    found = ids.mapInArrow(_marks(bits), "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[found["word"].to_numpy()] = found["mask"].to_numpy().astype(np.int64).view(np.uint64)
    return out


def rows_by_bitmap(docs: DataFrame, marked: np.ndarray, inside: bool, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose ``key`` is in the bitmap, or the others; null keys are among the others."""
    bits = int(len(marked) * 64).bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(key)).cast(pa.int64())
            at = _place(column.fill_null(0).to_numpy(), bits)
            hit = ((marked[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0) & column.is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(hit == inside))

    return docs.mapInArrow(run, docs.schema)


def only_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is in the frame ``ids(id)``."""
    return rows_by_bitmap(docs, bitmap(ids), True).join(ids.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is not in the frame ``ids(id)``; null ids stay."""
    marked = bitmap(ids)
    perhaps = rows_by_bitmap(docs, marked, True)
    rest = perhaps.join(ids.select(F.col("id").alias("_gone")), perhaps["doc_id"].cast("long") == F.col("_gone"), "left_anti")
    return rows_by_bitmap(docs, marked, False).unionByName(rest)
