"""Benchmark decontamination by template windows.

Texts become typed tokens: a number is ``NUM``, a unit after a number ``UNIT``, a
capitalised word inside a sentence ``NAME``, anything else the lower-case word;
signs are dropped. Windows of ``WINDOW`` tokens are hashed in two readings, with
and without ``NAME``; windows of more than 40 % placeholders without ``NAME`` are hashed
word for word instead. They are hash-joined with the windows of the benchmark. A match
counts if its slots are consistent: along the windows of one alignment whose slots
differ, a slot value of the item always meets the same value in the document and the
other way round. Windows with equal slots need no such proof; beside inconsistent
ones it takes ``VERBATIM`` of them. So copies are found, and also questions whose numbers, units or names
were exchanged throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lapsekit.llm.texts import flat, mix, pieces, span_hashes
from lapsekit.session import materialize

WINDOW, SHORTEST, BITS, VERBATIM = 10, 4, 24, 2

# Units of measure that may follow a number.
UNITS = [
    "mm", "cm", "m", "km", "in", "ft", "yd", "mi", "miles", "mile", "metres", "meters", "feet", "inches", "mg", "g", "kg", "t", "lb", "lbs",
    "oz", "grams", "kilograms", "pounds", "tons", "ml", "l", "litres", "liters", "gallons", "s", "sec", "seconds", "min", "minutes", "h",
    "hr", "hours", "hour", "days", "day", "weeks", "week", "months", "month", "years", "year", "usd", "eur", "gbp", "dollars", "euros",
    "cents", "percent", "kmh", "mph", "hz", "khz", "mhz", "ghz", "w", "kw", "v", "kb", "mb", "gb", "tb", "degrees", "kelvin",
]

_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?\n:"]] = True
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32


def _hash_words(texts: list[str]) -> np.ndarray:
    data, offsets = flat(pa.array(texts, pa.large_string()))
    return span_hashes(data, offsets[:-1], offsets[1:])


UNIT_HASHES = np.sort(_hash_words(UNITS))
NUM, UNIT, NAME = (mix(np.array([i], dtype=np.uint64))[0] for i in (101, 102, 103))


class Tokens:
    """Typed tokens of a text column: ``row``, ``value`` (hash of the word), ``plain`` and ``named`` readings."""

    def __init__(self, column: pa.Array) -> None:
        data, offsets = flat(column)
        digit, letter = _DIGIT[data], _LETTER[data]
        if len(data) > 2:
            inner = (data[1:-1] == 46) | (data[1:-1] == 44)
            digit[1:-1] |= inner & digit[:-2] & digit[2:]
        first, last = digit | letter, digit | letter
        first[1:] &= ~((digit[1:] & digit[:-1]) | (letter[1:] & letter[:-1]))
        last[:-1] &= ~((digit[1:] & digit[:-1]) | (letter[1:] & letter[:-1]))
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        first[edges] = (digit | letter)[edges]
        last[edges - 1] = (digit | letter)[edges - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        low = _LOW[data]
        if len(data) > 1:
            accent = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
            low[1:][accent] += 32
        self.rows = len(column)
        self.row = np.searchsorted(offsets, start, side="right") - 1
        self.value = span_hashes(low, start, end)
        number = digit[start]
        after = np.zeros(len(start), dtype=bool)
        after[1:] = number[:-1] & (self.row[1:] == self.row[:-1])
        unit = after & np.isin(self.value, UNIT_HASHES)
        stops = np.concatenate(([0], np.cumsum(_STOP[data])))
        inside = np.zeros(len(start), dtype=bool)
        inside[1:] = (self.row[1:] == self.row[:-1]) & (stops[start[1:]] == stops[end[:-1]])
        capital = (data[start] != low[start]) if len(start) else np.zeros(0, bool)
        second = np.minimum(start + 1, np.maximum(end - 1, 0))
        name = inside & capital & ~number & ~unit & (end - start > 1) & ((data[second] == low[second]) if len(start) else capital)
        self.slot = np.where(number, 1, 0) | np.where(unit, 2, 0)
        self.named_slot = self.slot | np.where(name, 4, 0)
        self.plain = np.where(number, NUM, np.where(unit, UNIT, self.value))
        self.named = np.where(name, NAME, self.plain)
        self.count = np.bincount(self.row, minlength=self.rows)
        self.begin = np.cumsum(self.count) - self.count

    def windows(self, size: int, reading: str) -> tuple[np.ndarray, np.ndarray]:
        """First token and hash of each window of ``size`` tokens; those with too few words besides placeholders only in the literal reading."""
        at = np.flatnonzero(np.arange(len(self.row)) - self.begin[self.row] + size <= self.count[self.row])
        if not len(at):
            return at, np.zeros(0, np.uint64)
        tokens = {"plain": self.plain, "named": self.named, "literal": self.value}[reading]
        slots = self.named_slot if reading == "named" else self.slot
        held = np.concatenate(([0], np.cumsum(slots > 0)))
        used = held[at + size] - held[at]
        crowded = used > size * 2 // 5
        at = at[crowded if reading == "literal" else ~crowded & ((used > 0) | (reading == "plain"))]
        value = np.full(len(at), size + 1000 * (reading == "literal"), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for i in range(size):
                value = value * np.uint64(0x9E3779B97F4A7C15) + tokens[at + i]
                value ^= value >> np.uint64(29)
        return at, mix(value)

    def slots(self, at: np.ndarray, size: int, reading: str) -> list[list[int]]:
        if reading == "literal":
            return [[]] * len(at)
        kinds = self.named_slot if reading == "named" else self.slot
        signed = self.value.astype(np.int64)
        return [[int(signed[i]) for i in range(a, a + size) if kinds[i]] for a in at]


SCHEMA = "id long, h long, place int, size int, slots array<long>"
READINGS = ("plain", "named", "literal")
_NAMES = ["id", "h", "place", "size", "slots"]


def _emit(ids: pa.Array, tokens: Tokens, at: np.ndarray, value: np.ndarray, size: int, reading: str) -> pa.RecordBatch:
    rows = tokens.row[at]
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(rows)), pa.array(value.astype(np.int64)), pa.array((at - tokens.begin[rows]).astype(np.int32)),
            pa.array(np.full(len(at), size, np.int32)), pa.array(tokens.slots(at, size, reading), pa.list_(pa.int64())),
        ],
        names=_NAMES,
    )


def _item_windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                tokens = Tokens(part.column("text"))
                for width in range(SHORTEST, size + 1):
                    for reading in READINGS:
                        at, value = tokens.windows(width, reading)
                        right = (tokens.count[tokens.row[at]] == width) | (width == size)
                        yield _emit(part.column("id"), tokens, at[right], value[right], width, reading)

    return run


def _document_windows(sizes: list[int], bitmap: np.ndarray):
    mask = np.uint64(len(bitmap) * 64 - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                tokens = Tokens(part.column("text"))
                for size in sizes:
                    for reading in READINGS:
                        at, value = tokens.windows(size, reading)
                        bit = value & mask
                        hit = (bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) > 0
                        if hit.any():
                            yield _emit(part.column("id"), tokens, at[hit], value[hit], size, reading)

    return run


def _bitmap(items: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of the items' window hashes: ``2 ** bits`` bits however large the benchmark is."""
    rows = items.select(F.col("h").bitwiseAND(F.lit((1 << bits) - 1)).alias("bit"))
    rows = rows.selectExpr("shiftright(bit, 6) as word", "shiftleft(1L, cast(bit & 63 as int)) as mask")
    found = rows.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[found["word"].to_numpy()] = found["mask"].to_numpy().astype(np.int64).view(np.uint64)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, bits: int = BITS) -> DataFrame:
    """``doc_id, item_id, n_windows, coverage, reparameterised`` for each document that holds a benchmark passage.

    ``docs(doc_id, text)``, ``benchmark(item_id, text)``. An item with fewer than
    ``window`` tokens is one window of its own length; items with fewer than four
    tokens are too short to tell and match nothing, like null and empty texts and
    null ids. ``coverage`` is the share of the item's windows found along the best
    alignment. Repeated rows give one row per pair of ids. Other columns are ignored.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), "text").where("id is not null")
    items = materialize(items.mapInArrow(_item_windows(window), SCHEMA).distinct(), "items")
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())
    if not sizes:
        sizes = [window]
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").where("id is not null")
    found = texts.mapInArrow(_document_windows(sizes, _bitmap(items, bits)), SCHEMA)

    a = found.select(F.col("id").alias("doc_id"), "h", F.col("place").alias("at"), F.col("slots").alias("x")).distinct()
    b = items.select(F.col("id").alias("item_id"), "h", F.col("place").alias("of"), F.col("slots").alias("y"))
    matched = a.join(b, "h").where(F.size("x") == F.size("y"))
    differs = F.col("x") != F.col("y")
    pairs = F.when(differs, F.arrays_zip(F.col("y").alias("y"), F.col("x").alias("x")))
    along = matched.groupBy("doc_id", "item_id", (F.col("at") - F.col("of")).alias("shift")).agg(
        F.count_distinct("of").alias("n"), F.count_distinct(F.when(~differs, F.col("of"))).alias("equal"),
        F.array_distinct(F.flatten(F.collect_set(pairs))).alias("slots"),
    )
    left, right = F.array_distinct(F.col("slots.y")), F.array_distinct(F.col("slots.x"))
    consistent = (F.size(left) == F.size("slots")) & (F.size(right) == F.size("slots"))
    along = along.withColumn("whole", consistent).withColumn("n", F.when(F.col("whole"), F.col("n")).otherwise(F.col("equal")))
    changed = F.col("whole") & (F.size("slots") > 0)
    total = items.groupBy(F.col("id").alias("item_id")).agg(F.count_distinct("place").alias("total"))
    per_item = along.where(F.col("whole") | (F.col("equal") >= VERBATIM)).withColumn("changed", changed).groupBy("doc_id", "item_id").agg(
        F.max("n").alias("n_windows"), F.min("changed").alias("reparameterised")
    )
    return per_item.join(total, "item_id").select(
        "doc_id", "item_id", "n_windows", (F.col("n_windows") / F.col("total")).alias("coverage"), "reparameterised"
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a benchmark passage, with all their columns; a null ``doc_id`` stays."""
    bad = materialize(contaminated(docs, benchmark).select(F.col("doc_id").alias("_bad")).distinct(), "contaminated")
    return docs.join(bad, docs["doc_id"].cast("long") == bad["_bad"], "left_anti")
