"""Hard negatives by coordinate pruning over length buckets.

All rows are dealt into blocks by a hash, so that equal vectors are spread, and each block
meets each group of anchors in one task. A block is indexed there: rows in order
of vector length, cut into buckets, and in each bucket the unit vectors' values of every coordinate
as a sorted list. For an anchor and the score its next hit must reach, a bucket is

- skipped, with all shorter ones, if not even its longest vector can reach the score;
- else narrowed: the score bounds the angle to the anchor, hence each coordinate of a
  unit vector to a range. The ranges of the anchor's largest coordinates are cut out of
  the sorted lists, and only rows in all of them are candidates;
- verified: the candidates' exact integer inner products decide and raise the score to reach.

Two such joins follow each other: the best rows of the anchor's label, then for each of
those the best rows of other labels inside the range of scores it allows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lapsekit.session import materialize

BUCKET, FOCUS = 1024, 4
#: Rows of a block: about four times the root of the table's, within these bounds; as many anchors make a group.
LEAST_ROWS, MOST_ROWS = 1024, 65536
#: Integer components beyond this count as it, so that scores of up to 1,024 components fit 64 bits.
LARGEST = 1 << 26
_MARGIN = 1e-9


class Bucket:
    """Rows of similar length with a sorted list of unit values for each coordinate."""

    def __init__(self, at: np.ndarray, vectors: np.ndarray, norms: np.ndarray) -> None:
        self.at = at
        self.longest = float(norms.max(initial=0.0))
        unit = (vectors / np.where(norms > 0, norms, 1.0)[:, None]).T
        self.order = np.argsort(unit, axis=1, kind="stable")
        self.values = np.take_along_axis(unit, self.order, axis=1)

    def candidates(self, unit: np.ndarray, focus: np.ndarray, cosine: float) -> np.ndarray:
        """Places of the rows that may have at least this cosine with an anchor."""
        beta = np.arccos(min(cosine, 1.0))
        alpha = np.arccos(np.clip(unit[focus], -1.0, 1.0))
        low = np.cos(np.minimum(alpha + beta, np.pi)) - _MARGIN
        high = np.cos(np.maximum(alpha - beta, 0.0)) + _MARGIN
        hits, lists = np.zeros(len(self.at), dtype=np.int8), 0
        for f, a, b in zip(focus, low, high):
            values = self.values[f]
            begin, end = np.searchsorted(values, a, side="left"), np.searchsorted(values, b, side="right")
            if end - begin < len(values):
                hits[self.order[f, begin:end]] += 1
                lists += 1
        return self.at if not lists else self.at[hits == lists]


class Index:
    """Length buckets over vectors of one dimension, longest first."""

    def __init__(self, vectors: np.ndarray) -> None:
        exact = vectors.astype(np.float64)
        self.vectors, self.floats = vectors, exact
        self.largest = int(np.abs(vectors).max(initial=0))
        norms = np.sqrt((exact * exact).sum(axis=1))
        order = np.argsort(-norms, kind="stable")
        parts = [order[i : i + BUCKET] for i in range(0, len(order), BUCKET)]
        self.buckets = [Bucket(at, exact[at], norms[at]) for at in parts]

    def scores(self, anchor: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact inner products; doubles where no sum can pass 53 bits."""
        if self.largest * max(int(np.abs(anchor).max(initial=0)), 1) * max(len(anchor), 1) < 1 << 53:
            return np.rint(self.floats[at] @ anchor.astype(np.float64)).astype(np.int64)
        return self.vectors[at].astype(np.int64) @ anchor.astype(np.int64)

    def search(self, anchor: np.ndarray, reach: Callable[[], int | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places and scores of the candidates, bucket by bucket; ``reach`` tells the least score that still counts."""
        length = float(np.sqrt((anchor.astype(np.float64) ** 2).sum()))
        unit = anchor / length if length else anchor.astype(np.float64)
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        for bucket in self.buckets:
            least, at = reach(), bucket.at
            if least is not None and least > 0:
                most = length * bucket.longest
                if most * (1 + _MARGIN) < least:
                    return
                at = bucket.candidates(unit, focus, least / most - _MARGIN)
            if len(at):
                yield at, self.scores(anchor, at)


class Best:
    """The best ``k`` rows seen, by score, then smaller id, then mark."""

    def __init__(self, k: int, low: int | None = None, high: int | None = None) -> None:
        self.k, self.low, self.high = k, low, high
        self.score = self.id = self.mark = np.zeros(0, dtype=np.int64)

    def reach(self) -> int | None:
        return int(self.score[-1]) if len(self.score) == self.k else self.low

    def add(self, score: np.ndarray, ids: np.ndarray, marks: np.ndarray) -> None:
        least = self.reach()
        held = np.ones(len(score), dtype=bool)
        if least is not None:
            held &= score >= least
        if self.high is not None:
            held &= score <= self.high
        if held.any():
            score, ids, marks = (np.concatenate(x) for x in ((self.score, score[held]), (self.id, ids[held]), (self.mark, marks[held])))
            order = np.lexsort((marks, ids, -score))[: self.k]
            self.score, self.id, self.mark = score[order], ids[order], marks[order]


def _by_size(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows of each dimension: their places and their vectors as one array."""
    lists = table["q"].combine_chunks()
    ends = lists.offsets.to_numpy()
    values, sizes = lists.values.to_numpy(), np.diff(ends)
    out = {}
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        out[int(size)] = at, values[ends[at][:, None] + np.arange(size)]
    return out


def _positives(k: int):
    schema = pa.schema([(c, pa.int64()) for c in ("anchor_id", "anchor_mark", "other_id", "other_mark", "score")])

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        """The best ``k`` rows of each anchor's label in this block."""
        found = []
        if rows.num_rows and anchors.num_rows:
            ids, marks = rows["vec_id"].to_numpy(), rows["mark"].to_numpy()
            labels = pa.concat_arrays([rows["label"].combine_chunks(), anchors["label"].combine_chunks()]).dictionary_encode().indices.to_numpy()
            mine, wanted = labels[: len(ids)], labels[len(ids) :]
            blocks = _by_size(rows)
            a_ids, a_marks = anchors["vec_id"].to_numpy(), anchors["mark"].to_numpy()
            for size, (places, vectors) in _by_size(anchors).items():
                if size not in blocks:
                    continue
                at, block = blocks[size]
                for label in np.unique(wanted[places]):
                    inside = at[mine[at] == label]
                    index = Index(block[mine[at] == label])
                    for i in np.flatnonzero(wanted[places] == label):
                        best, place = Best(k), places[i]
                        for hit, score in index.search(vectors[i], best.reach):
                            other = (ids[inside[hit]] != a_ids[place]) | (marks[inside[hit]] != a_marks[place])
                            best.add(score[other], ids[inside[hit]][other], marks[inside[hit]][other])
                        own = np.full((len(best.id), 2), [a_ids[place], a_marks[place]])
                        found.append(np.column_stack((own, best.id, best.mark, best.score)))
        return _as_table(found, schema)

    return run


def _negatives(k: int, low: int, high: int):
    schema = pa.schema([(c, pa.int64()) for c in ("anchor_id", "anchor_mark", "positive_score", "other_id", "other_mark", "score")])

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        """For each anchor and positive score, the best ``k`` rows of other labels in this block inside its range."""
        found = []
        if rows.num_rows and anchors.num_rows:
            ids, marks = rows["vec_id"].to_numpy(), rows["mark"].to_numpy()
            labels = pa.concat_arrays([rows["label"].combine_chunks(), anchors["label"].combine_chunks()]).dictionary_encode().indices.to_numpy()
            mine, wanted = labels[: len(ids)], labels[len(ids) :]
            blocks = _by_size(rows)
            a_ids, a_marks, allowed = anchors["vec_id"].to_numpy(), anchors["mark"].to_numpy(), anchors["scores"].to_pylist()
            for size, (places, vectors) in _by_size(anchors).items():
                if size not in blocks:
                    continue
                at, block = blocks[size]
                index = Index(block)
                for place, vector in zip(places, vectors):
                    ranges = {s: (-(-low * s // 100), high * s // 100) for s in allowed[place]}
                    bests = {s: Best(k, a, b) for s, (a, b) in ranges.items() if a <= b}
                    if not bests:
                        continue
                    for hit, score in index.search(vector, lambda: min(b.reach() for b in bests.values())):
                        other = at[hit][mine[at[hit]] != wanted[place]]
                        values = score[mine[at[hit]] != wanted[place]]
                        for best in bests.values():
                            best.add(values, ids[other], marks[other])
                    for s, best in bests.items():
                        own = np.full((len(best.id), 3), [a_ids[place], a_marks[place], s])
                        found.append(np.column_stack((own, best.id, best.mark, best.score)))
        return _as_table(found, schema)

    return run


def _as_table(found: list[np.ndarray], schema: pa.Schema) -> pa.Table:
    values = np.concatenate(found) if found else np.zeros((0, len(schema)), dtype=np.int64)
    return pa.table([pa.array(values[:, i]) for i in range(len(schema))], schema=schema)


def _met(rows: DataFrame, anchors: DataFrame, run: Callable, schema: str, n: int, anchors_n: int) -> DataFrame:
    """Every block of rows with every group of anchors, one pair a task."""
    size = max(LEAST_ROWS, min(MOST_ROWS, int(4 * n**0.5)))
    blocks, groups = max(1, -(-n // size)), max(1, -(-anchors_n // size))

    def dealt(df: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        out = df.withColumn(own, F.pmod(F.xxhash64("vec_id", "mark"), F.lit(parts)).cast("int"))
        return out.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    left = dealt(rows, "block", blocks, "grp", groups).groupBy("block", "grp")
    right = dealt(anchors.toDF(*anchors.columns), "grp", groups, "block", blocks).groupBy("block", "grp")
    return left.cogroup(right).applyInArrow(run, schema)


def prepared(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, label, q, mark`` of the rows that take part: integer components ``floor(scale * x)``."""
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    usable = base.where("vec_id is not null and label is not null and v is not null")
    usable = usable.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))

    def whole(x):
        floor = F.floor(F.lit(float(scale)) * F.least(F.greatest(x, F.lit(-float(LARGEST))), F.lit(float(LARGEST))))
        return F.least(F.greatest(floor, F.lit(-LARGEST)), F.lit(LARGEST)).cast("int")

    return usable.select("vec_id", "label", F.transform("v", whole).alias("q")).distinct().withColumn("mark", F.xxhash64("label", "q"))


def mine(
    vectors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, every: int = 50, scale: int = 256,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from ``vectors(vec_id, label, embedding)``.

    Anchors are the rows whose ``vec_id`` is divisible by ``every``. An anchor's positives are its
    best ``positives`` other rows of the same label, its negatives for one of them the best
    ``negatives`` rows of other labels whose score is ``low`` to ``high`` percent of the positive's. Scores are
    inner products of the integer vectors; equal ones go by smaller id. All rows are compared with all anchors.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part.
    Rows equal in id, label and vector are one row; equal ids with other content are rows of
    their own. Vectors of different dimension have no score with each other. Integer components are
    held to ``LARGEST``. Anchors without positives or negatives have no rows; an empty table gives none; other columns
    are ignored.
    """
    rows = materialize(prepared(vectors, scale), "integer-vectors")
    anchors = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    n, anchors_n = rows.count(), anchors.count()
    key = ["anchor_id", "anchor_mark"]
    schema = "anchor_id long, anchor_mark long, other_id long, other_mark long, score long"
    order = Window.partitionBy(*key).orderBy(F.desc("score"), "other_id", "other_mark")
    best = _met(rows, anchors, _positives(positives), schema, n, anchors_n)
    best = best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    best = materialize(best.select(*key, F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    scores = best.groupBy(*key).agg(F.collect_set("positive_score").alias("scores"))
    asked = anchors.join(scores.withColumnsRenamed({"anchor_id": "vec_id", "anchor_mark": "mark"}), ["vec_id", "mark"])
    schema = "anchor_id long, anchor_mark long, positive_score long, other_id long, other_mark long, score long"
    order = Window.partitionBy(*key, "positive_score").orderBy(F.desc("score"), "other_id", "other_mark")
    hard = _met(rows, asked, _negatives(negatives, low, high), schema, n, anchors_n)
    hard = hard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    hard = hard.select(*key, "positive_score", "rank", F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"))
    found = best.join(hard, [*key, "positive_score"])
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
