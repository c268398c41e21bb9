"""Collocations by top-order marginalisation.

Each word of a text begins one window of up to five words that stops at the end of its
piece; missing places are null. Only these longest windows are counted. Spark's ROLLUP
over language and the five columns then sums them to ever shorter prefixes: every
phrase is the prefix of exactly the windows that begin where it occurs, so all
phrase counts, the counts of single words and the number of words come from one pass.

A phrase that occurs often consists of words, pairs and triples that do. Three bitmaps of
fixed size, of those counted by 64-bit hashes, end a window early where it would hold a
rarer one: such windows are nearly all different and would fill the shuffle for nothing. Hashes that
collide let a window grow too long, which changes no count that is kept; the windows
themselves hold the words as text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lapsekit.llm.idfilter import bitmap
from lapsekit.llm.texts import flat, lowered, mix, pieces, span_hashes
from lapsekit.session import materialize

LONGEST, FILTERED = 5, 3
UNKNOWN = "und"
#: Bytes of text taken at a time where hashes and where windows are counted.
SLICE, WINDOW_SLICE = 1 << 21, 1 << 19
#: Bits of the hashes that are counted; and how many counts of them a task gathers before it hands them on.
HASH_BITS, GATHERED = 40, 1 << 20
#: Word columns of a window, and what stands for a word too rare to begin a phrase (no word is empty).
COLUMNS = [f"w{i}" for i in range(1, LONGEST + 1)]
RARE = ""
#: Exact in 38 decimal digits.
SCORE = (
    "cast(1000BD * cast(a as decimal(18, 0)) as decimal(22, 0)) * cast(n as decimal(16, 0)) "
    "div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))"
)
_SPLIT = np.zeros(256, dtype=bool)
_SPLIT[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_GAP = _SPLIT.copy()
_GAP[[ord(" "), ord("\t")]] = True


class _Words:
    """The words of a batch: start, end, row, and whether the next word follows in the same piece."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        data, offsets = flat(batch.column("text"))
        self.data = data = lowered(data)
        inside = ~_GAP[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        edges = offsets[1:-1]
        edges = edges[(edges < len(data)) & (edges > 0)]
        first[edges] = inside[edges]
        last[edges - 1] = inside[edges - 1]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.row = np.searchsorted(offsets, self.start, side="right") - 1
        splits = np.concatenate((np.zeros(1, np.int32), np.cumsum(_SPLIT[data], dtype=np.int32)))
        n = len(self.start)
        self.follows = np.zeros(n, dtype=bool)
        if n > 1:
            self.follows[:-1] = (self.row[1:] == self.row[:-1]) & (splits[self.start[1:]] == splits[self.end[:-1]])
        lang = batch.column("lang")
        self.langs = lang.dictionary_encode()
        code = np.asarray(self.langs.indices)[self.row] if n else np.zeros(0, np.int64)
        data_l, offsets_l = flat(self.langs.dictionary)
        salt = span_hashes(data_l, offsets_l[:-1], offsets_l[1:])
        self.lang = code
        self.hash = mix(span_hashes(data, self.start, self.end) ^ mix(salt[code])) if n else np.zeros(0, np.uint64)

    def joined(self, hashes: np.ndarray) -> np.ndarray:
        """From hashes of runs of words, those of the runs one word longer; meaningless where none follows."""
        out = hashes.copy()
        with np.errstate(over="ignore"):
            out[:-1] = mix(self.hash[:-1] * np.uint64(3) + mix(hashes[1:]))
        return out

    def frequent(self, marked: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Which words begin a frequent run of 1, 2, ... words by the bitmaps so far; which may begin a run one longer, and its hashes."""
        held, hashes = [], self.hash
        may = np.ones(len(self.start), dtype=bool)
        for bits in marked:
            often = may.copy()
            often[may] = _in(bits, hashes[may])
            held.append(often)
            may = often & self.follows
            may[:-1] &= often[1:]
            hashes = self.joined(hashes)
        return held, may, hashes


def _shortened(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - HASH_BITS)


def _in(marked: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = int(len(marked) * 64).bit_length() - 1
    at = (mix(_shortened(hashes)) >> np.uint64(64 - bits)).astype(np.int64)
    return (marked[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0


def _hash_counts(marked: list[np.ndarray]):
    """Counts of the hashed runs that are one word longer than the last bitmap's."""

    def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        hashes, counts = (np.concatenate(x) for x in zip(*parts))
        value, place = np.unique(hashes, return_inverse=True)
        total = np.bincount(place, weights=counts, minlength=len(value)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(value.astype(np.int64)), pa.array(total)], names=["id", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for part in pieces(batch, "text", SLICE):
                _, may, hashes = _Words(part).frequent(marked)
                parts.append(np.unique(_shortened(hashes[may]), return_counts=True))
                held += len(parts[-1][0])
                if held > GATHERED:
                    yield summed(parts)
                    parts, held = [], 0
        if parts:
            yield summed(parts)

    return run


def _windows(marked: list[np.ndarray]):
    """The longest windows of each slice with their counts; Spark's partial aggregate combines a task's slices."""
    keys = ["lang", *COLUMNS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", WINDOW_SLICE):
                found = _Words(part)
                n = len(found.start)
                if not n:
                    continue
                often, *longer = found.frequent(marked)[0]
                # Words as numbers, equal texts by equal number; 0 is rare, -1 is padding.
                texts = pa.BinaryArray.from_buffers(
                    pa.binary(), n, [None, pa.py_buffer(_offsets(found)), pa.py_buffer(_packed(found))]
                ).dictionary_encode()
                number = np.where(often, np.asarray(texts.indices).astype(np.int64) + 1, 0)
                columns, alive = [found.lang.astype(np.int64), number], often
                for i in range(1, LONGEST):
                    # The i-th further word stands if every run of bitmap length up to it is frequent.
                    run_ = longer[min(i, len(longer)) - 1]
                    back = max(0, i - len(longer))
                    alive = alive & np.concatenate((run_[back:], np.zeros(min(back, n), dtype=bool)))
                    column = np.full(n, -1, dtype=np.int64)
                    at = np.flatnonzero(alive)
                    column[at] = number[at + i]
                    columns.append(column)
                table = pa.table(columns, names=keys).group_by(keys).aggregate([([], "count_all")]).combine_chunks()
                names = pa.concat_arrays([pa.array([RARE]), texts.dictionary.cast(pa.string())])
                out = [found.langs.dictionary.take(table["lang"].combine_chunks())]
                for c in COLUMNS:
                    codes = table[c].combine_chunks().to_numpy()
                    out.append(names.take(pa.array(codes, mask=codes < 0)))
                yield pa.RecordBatch.from_arrays([*out, table["count_all"].combine_chunks()], names=[*keys, "n"])

    return run


def _offsets(found: _Words) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(found.end - found.start))).astype(np.int32)


def _packed(found: _Words) -> np.ndarray:
    inside = np.zeros(len(found.data) + 1, dtype=np.int8)
    inside[found.start] = 1
    inside[found.end] -= 1
    return found.data[np.cumsum(inside[:-1], dtype=np.int8).view(bool)]


def phrase_counts(docs: DataFrame, least: int = 100) -> tuple[DataFrame, DataFrame]:
    """``lang, n`` and ``lang, size, phrase, f`` of all phrases of up to five words that occur ``least`` times."""
    base = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")

    marked: list[np.ndarray] = []
    for _ in range(FILTERED):
        counts = base.mapInArrow(_hash_counts(list(marked)), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
        marked.append(bitmap(counts.where(F.col("n") >= least).select("id")))
    windows = base.mapInArrow(_windows(marked), f"lang string, {', '.join(f'{c} string' for c in COLUMNS)}, n long")
    whole = windows.groupBy("lang", *COLUMNS).agg(F.sum("n").alias("n"))
    rolled = whole.rollup("lang", *COLUMNS).agg(F.grouping_id().alias("_gid"), F.sum("n").alias("f"))
    # grouping_id() has one bit per column that is summed over: size words stand when the last LONGEST - size bits are set.
    size = F.when(F.col("_gid") == 2 ** (LONGEST + 1) - 1, -1)
    for k in range(LONGEST + 1):
        size = size.when(F.col("_gid") == 2 ** (LONGEST - k) - 1, k)
    last = F.coalesce(*[F.when(F.col("size") == k, F.col(c)) for k, c in enumerate(COLUMNS, 1)])
    rolled = rolled.withColumn("size", size)
    kept = rolled.where((F.col("size") == 0) | (last.isNotNull() & (F.col("w1") != RARE) & (F.col("f") >= least)))
    table = materialize(kept.select("lang", "size", F.concat_ws(" ", *COLUMNS).alias("phrase"), "f"), "phrases")
    return table.where("size = 0").select("lang", F.col("f").alias("n")), table.where("size > 0")


def collocations(docs: DataFrame, least: int = 100, best: int = 2000, absorbed: int = 100) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the ``best`` phrases of each language of ``docs(text, lang)``.

    A phrase of 2 to 5 words that occurs ``least`` times is a candidate. Of its cuts in two the
    one with the lowest ``floor(1000 * a * n / (l * r))`` counts, the first of equal ones; products
    are decimals of 38 digits. A candidate goes when a longer one around it occurs at least
    ``absorbed`` percent as often; as counts never grow with length, one more word on
    either side shows that.

    A null language is ``und``; null, empty and blank texts have no words; repeated rows count
    each time; ties in score and count are in order of the phrase's UTF-8 bytes; an empty
    table has no rows; other columns are ignored. Long texts are taken whole, with about 60
    bytes of arrays per byte of the longest. A frequent word or passage is one row per slice.
    """
    totals, phrases = phrase_counts(docs, least)
    candidates = phrases.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"))
    words = F.split("phrase", " ")
    cut = candidates.withColumn("words", words).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cut = cut.withColumn("left", F.concat_ws(" ", F.expr("slice(words, 1, k)")))
    cut = cut.withColumn("right", F.concat_ws(" ", F.expr("slice(words, k + 1, size - k)"))).drop("words")
    counts = phrases.select("lang", "phrase", "f")
    cut = cut.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cut = cut.join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    cut = cut.join(totals, "lang")
    scored = cut.withColumn("score", F.expr(SCORE)).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut")
    )
    around = candidates.where("size > 2").withColumn("words", F.split("phrase", " "))
    inner = F.array(F.expr("slice(words, 1, size - 1)"), F.expr("slice(words, 2, size - 1)"))
    around = around.select("lang", F.explode(inner).alias("part"), F.col("a").alias("outer"))
    around = around.groupBy("lang", F.concat_ws(" ", "part").alias("phrase")).agg(F.max("outer").alias("outer"))
    kept = scored.join(around, ["lang", "phrase"], "left").where(F.expr(f"outer is null or 100 * outer < {absorbed} * cut.a"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    flat_ = kept.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score")
    ranked = flat_.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= best)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
