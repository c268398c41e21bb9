"""Random forests grown a tree at a time, each by one task over the whole binned table.

Spark's forest grows all trees level by level: it holds a count for every tree with each row, reads all of
them again on each pass and shuffles the histograms of all nodes from every partition. Here every feature
value is first replaced by the number of its bin, a byte where bins times classes allow it; each task
gets these bytes once, in a file of its own, and grows its share of the trees without any exchange. A
tree's rows stay grouped by node, in files too, so a task's memory holds a piece of rows and the histograms of a few nodes.

The definitions are Spark's: candidate splits from the ranks of the values, Poisson bags, a random
subset of features per node, the first best gain, children of equal prediction merged. The result is
Spark's own model, read from its own file layout.
"""

from __future__ import annotations

import json
import math
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from lapsekit.session import materialize, shared_folder

# Tables of at most this many rows are left to Spark's forest, which takes its candidate splits from as many.
FEW_ROWS = 10_000
MOST_CLASSES = 1000
# Rows whose draws share a random sequence: the bags depend on it, and on nothing below.
DRAWN = 1 << 18
# Rows of a piece, bytes of a block of bins and of the histograms held at a time, values of a feature's summary.
PIECE, BLOCK_BYTES, HISTOGRAM_BYTES, SUMMARY = 1 << 18, 1 << 20, 1 << 23, 2048
# A node of fewer rows than this is counted together with its neighbours.
SMALL_NODE = 2048
EPSILON = 2.0**-52

NODE = (
    "treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,"
    "leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>"
)


class Forest(RandomForestClassifier):
    """Spark's random forest; tables of more than ``few_rows`` rows are grown by :func:`grow`.

    Its trees follow the same definitions with other random draws. Spark's own also grows what is not
    covered here: features with more than two unordered categories, weights that differ within a class, a single class.
    """

    few_rows = FEW_ROWS

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        sizes = _class_sizes(self, dataset)
        if sizes is None or sum(n for n, _ in sizes) <= self.few_rows:
            return super()._fit(dataset)
        return grow(self, dataset, sizes)


def _class_sizes(forest: RandomForestClassifier, dataset: DataFrame) -> list[tuple[int, float]] | None:
    """Rows and weight of each class by its number; None where Spark's own forest has to be used."""
    slots = dataset.schema[forest.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    if not forest.getBootstrap() or any(a.get("num_vals", len(a.get("vals", ()))) != 2 for a in slots.get("nominal", ())):
        return None
    weight = F.col(forest.getWeightCol()).cast("double") if forest.isDefined(forest.weightCol) and forest.getWeightCol() else F.lit(1.0)
    label = F.col(forest.getLabelCol()).cast("double").alias("label")
    found = dataset.select(label, weight.alias("w")).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.min("w").alias("w"), F.max("w").alias("most"), F.count("w").alias("weighted"))
    rows = found.limit(MOST_CLASSES + 1).collect()
    plain = all(r["label"] is not None and r["label"] >= 0 and r["label"] % 1 == 0 and r["weighted"] == r["n"] and r["w"] == r["most"] and r["w"] > 0 for r in rows)
    if not rows or not plain or not 0 < max(r["label"] for r in rows) < MOST_CLASSES:
        return None
    by_class = {int(r["label"]): (r["n"], r["w"]) for r in rows}
    return [by_class.get(c, (0, 1.0)) for c in range(max(by_class) + 1)]


def subset_size(strategy: str, n_features: int, n_trees: int) -> int:
    """Features tried per node, as Spark counts them."""
    if strategy == "auto":
        strategy = "all" if n_trees == 1 else "sqrt"
    named = {"all": n_features, "sqrt": math.sqrt(n_features), "log2": math.log2(n_features), "onethird": n_features / 3}
    if strategy in named:
        return max(1, math.ceil(named[strategy]))
    if strategy.isdigit():
        return min(int(strategy), n_features)
    return max(1, math.ceil(float(strategy) * n_features))


def _summary(values: np.ndarray, weights: np.ndarray, most: int = SUMMARY) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values with their weights; of more than ``most``, one for each equal share of the weight."""
    order = np.argsort(values, kind="stable")
    values, weights = values[order], weights[order]
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    values, weights = values[first], np.add.reduceat(weights, first)
    if len(values) <= most:
        return values, weights
    until = np.cumsum(weights)
    share = ((until - weights / 2) / until[-1] * most).astype(np.int64)
    first = np.flatnonzero(np.r_[True, share[1:] != share[:-1]])
    last = np.r_[first[1:], len(values)]
    return values[(first + last - 1) // 2], np.add.reduceat(weights, first)


def candidate_splits(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """Thresholds between sorted distinct values: all of them if ``most`` suffice, else those nearest to equal shares."""
    middle = (values[1:] + values[:-1]) / 2
    if len(middle) <= most:
        return middle
    until = np.cumsum(weights)
    stride, target, found = until[-1] / (most + 1), until[-1] / (most + 1), []
    for i in range(len(middle)):
        if abs(until[i] - target) < abs(until[i + 1] - target):
            found.append(middle[i])
            target += stride
    return np.array(found)


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The features as rows of a matrix, and the class numbers."""
    flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1), batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)


def _summaries(weights: list[float]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each partition's summary of every feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held = np.array(weights), None
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _matrix(batch)
            found = [_summary(x[:, f], of[y]) for f in range(x.shape[1])]
            if held is not None:
                found = [_summary(np.r_[a, c], np.r_[b, d]) for (a, b), (c, d) in zip(held, found)]
            held = found
        for f, (v, w) in enumerate(held or []):
            yield pa.RecordBatch.from_pydict({"feature": pa.array(np.full(len(v), f, np.int32)), "value": pa.array(v), "weight": pa.array(w)})

    return run


def _thresholds(most: int) -> Callable[[pa.Table], pa.Table]:
    def run(found: pa.Table) -> pa.Table:
        values, weights = _summary(found["value"].to_numpy(), found["weight"].to_numpy(), found.num_rows)
        cuts = candidate_splits(values, weights, most)
        cuts = np.unique(cuts[~np.isnan(cuts)])
        return pa.table({"feature": found["feature"].slice(0, 1), "cuts": pa.array([cuts.tolist()], pa.list_(pa.float64()))})

    return run


def _blocks(cuts: list[np.ndarray], n_classes: int, kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of rows: per feature and row the bin number times the classes plus the class."""
    size = max(1, BLOCK_BYTES // (len(cuts) * np.dtype(kind).itemsize))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, rows = TaskContext.get().partitionId(), 0, [], 0

        def block(codes: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()), "n": pa.array([codes.shape[1]], pa.int32()),
                "codes": pa.array([np.ascontiguousarray(codes).tobytes()], pa.binary()),
            })

        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _matrix(batch)
            codes = np.empty(x.shape[::-1], kind)
            for f, cut in enumerate(cuts):
                codes[f] = np.searchsorted(cut, x[:, f]) * n_classes + y
            held, rows = [*held, codes], rows + x.shape[0]
            while rows >= size:
                whole = np.concatenate(held, axis=1)
                yield block(whole[:, :size])
                number, held, rows = number + 1, [whole[:, size:].copy()], rows - size
        if rows:
            yield block(np.concatenate(held, axis=1))

    return run


def _impurity(counts: np.ndarray, kind: str) -> np.ndarray:
    """Of class weights in the last axis; 0 where there are none."""
    total = counts.sum(-1, keepdims=True)
    share = np.divide(counts, total, out=np.zeros_like(counts), where=total > 0)
    if kind == "gini":
        return np.where(total[..., 0] > 0, 1 - (share * share).sum(-1), 0.0)
    return -(share * np.log2(share, out=np.zeros_like(share), where=share > 0)).sum(-1)


class _Tree:
    """One tree over the codes of all rows. ``rows`` and ``spare`` hold its rows by node, ``weight`` each row's draws."""

    def __init__(self, spec: dict[str, Any], number: int, codes: np.ndarray, rows: np.ndarray, spare: np.ndarray, weight: np.ndarray):
        self.spec, self.number, self.codes, self.rows, self.spare, self.weight = spec, number, codes, rows, spare, weight
        self.n_classes, self.width = spec["n_classes"], spec["n_bins"] * spec["n_classes"]
        self.shape = (spec["n_tried"], spec["n_bins"], self.n_classes)
        self.of_class = np.array(spec["weights"])
        # Nodes in breadth-first order: class counts, and for split ones the feature, bin, gain and children.
        self.counts: list[np.ndarray] = []
        self.splits: list[np.ndarray] = []

    def grow(self) -> None:
        n, counts = self._bag()
        level, begins, nodes, made = 0, np.array([0, n]), np.array([0]), 1
        counts = counts[None, :]
        self.counts.append(counts)
        if self.spec["max_depth"] == 0 or _impurity(counts * self.of_class, self.spec["impurity"])[0] < EPSILON:
            nodes = nodes[:0]
        while len(nodes):
            rng = np.random.default_rng([self.spec["seed"], self.number, 1, level])
            at, next_begins, next_nodes, next_counts = 0, [0], [], []
            for i, j in self._batches(begins):
                tried = self._tried(rng, j - i)
                hist = self._counted(begins[i : j + 1], tried)
                feature, bin_, gain, left, right = self._chosen(hist, counts[i:j], tried)
                alive = []
                for part in (left, right):
                    alive.append((_impurity(part * self.of_class, self.spec["impurity"]) >= EPSILON) & (level + 1 < self.spec["max_depth"]))
                split = np.flatnonzero(gain > 0)
                child = np.full((j - i, 2), -1, np.int64)
                child[split, 0] = made + 2 * np.arange(len(split))
                child[split, 1] = child[split, 0] + 1
                made += 2 * len(split)
                self.splits.append(np.column_stack([nodes[i:j], feature, bin_, child, gain])[split])
                self.counts.append(np.stack([left[split], right[split]], 1).reshape(-1, self.n_classes))
                keeps = np.column_stack(alive) & (gain > 0)[:, None]
                sizes = self._dealt(begins[i : j + 1], feature, bin_, keeps, at)
                chosen = keeps.ravel()
                next_nodes.append(child.ravel()[chosen])
                next_counts.append(np.stack([left, right], 1).reshape(-1, self.n_classes)[chosen])
                next_begins.append(at + np.cumsum(sizes))
                at += int(sizes.sum())
            self.rows, self.spare = self.spare, self.rows
            level, nodes, counts, begins = level + 1, np.concatenate(next_nodes), np.concatenate(next_counts), np.r_[0, np.concatenate(next_begins[1:])]

    def _bag(self) -> tuple[int, np.ndarray]:
        """Draw the rows; returns how many are in the bag and the draws by class."""
        rate, upto, chances = self.spec["rate"], 0.0, []
        while not chances or chances[-1] < 1 - 1e-15 and len(chances) < 64:
            upto += math.exp(-rate) * rate ** len(chances) / math.factorial(len(chances))
            chances.append(upto)
        table, at, counts = np.array(chances[:-1]), 0, np.zeros(self.n_classes)
        for number, lo in enumerate(range(0, len(self.weight), DRAWN)):
            hi = min(lo + DRAWN, len(self.weight))
            draws = np.searchsorted(table, np.random.default_rng([self.spec["seed"], self.number, 0, number]).random(hi - lo), "right")
            self.weight[lo:hi] = draws
            inside = np.flatnonzero(draws)
            self.rows[at : at + len(inside)] = inside + lo
            at += len(inside)
            counts += np.bincount(self.codes[0, lo:hi] % self.n_classes, draws, self.n_classes)
        return at, counts

    def _batches(self, begins: np.ndarray) -> Iterator[tuple[int, int]]:
        """Neighbouring nodes that together hold at most a piece of rows and have few enough histograms."""
        most, i = max(1, min(HISTOGRAM_BYTES // (8 * math.prod(self.shape)), 1 << 14)), 0
        while i < len(begins) - 1:
            j = int(np.searchsorted(begins, begins[i] + PIECE, "right")) - 1
            j = min(max(j, i + 1), i + most, len(begins) - 1)
            yield i, j
            i = j

    def _tried(self, rng: np.random.Generator, n: int) -> np.ndarray:
        """The features each node may split by."""
        n_features, k = len(self.codes), self.spec["n_tried"]
        if k == n_features:
            return np.broadcast_to(np.arange(k), (n, k))
        step = max(1, HISTOGRAM_BYTES // (8 * n_features))
        parts = [np.argpartition(rng.random((min(step, n - i), n_features)), k, axis=1)[:, :k] for i in range(0, n, step)]
        return np.sort(np.concatenate(parts), axis=1)

    def _counted(self, begins: np.ndarray, tried: np.ndarray) -> np.ndarray:
        """Draws by node, tried feature, bin and class."""
        n, k = tried.shape
        lo, hi = int(begins[0]), int(begins[-1])
        if n > 1 and hi - lo < SMALL_NODE * n:
            rows, sizes = np.asarray(self.rows[lo:hi]).astype(np.int64), np.diff(begins)
            weight, first = self.weight.take(rows).astype(np.float64), np.repeat(np.arange(n) * self.width, sizes)
            out = np.empty((n, k, self.width))
            flat = self.codes.reshape(-1)
            for j in range(k):
                place = flat.take(np.repeat(tried[:, j] * self.codes.shape[1], sizes) + rows) + first
                out[:, j] = np.bincount(place, weight, n * self.width).reshape(n, self.width)
            return out.reshape(n, *self.shape)
        out = np.zeros((n, k, self.width))
        for i in range(n):
            for at in range(int(begins[i]), int(begins[i + 1]), PIECE):
                rows = np.asarray(self.rows[at : min(at + PIECE, int(begins[i + 1]))]).astype(np.int64)
                weight = self.weight.take(rows).astype(np.float64)
                for j in range(k):
                    out[i, j] += np.bincount(self.codes[tried[i, j]].take(rows), weight, self.width)
        return out.reshape(n, *self.shape)

    def _chosen(self, hist: np.ndarray, counts: np.ndarray, tried: np.ndarray) -> tuple[np.ndarray, ...]:
        """Feature, bin, gain (0 or less: a leaf) and the class counts of both sides, per node."""
        n, spec = len(hist), self.spec
        left = np.cumsum(hist, axis=2)[:, :, :-1]
        right = counts[:, None, None, :] - left
        gain = np.repeat(_impurity(counts * self.of_class, spec["impurity"]), left[0, :, :, 0].size).reshape(left.shape[:3])
        total = (counts * self.of_class).sum(-1)[:, None, None]
        valid = np.ones(left.shape[:3], bool)
        for side in (left, right):
            valid &= side.sum(-1) >= spec["min_rows"]
            weighted = side * self.of_class
            share = weighted.sum(-1) / total
            valid &= share >= spec["min_share"]
            gain -= share * _impurity(weighted, spec["impurity"])
        gain[~valid | (gain < spec["min_gain"])] = -1.0
        best = gain.reshape(n, -1).argmax(1)
        at, bin_ = np.divmod(best, left.shape[2])
        nodes = np.arange(n)
        return tried[nodes, at], bin_, gain.reshape(n, -1)[nodes, best], left[nodes, at, bin_], right[nodes, at, bin_]

    def _dealt(self, begins: np.ndarray, feature: np.ndarray, bin_: np.ndarray, keeps: np.ndarray, at: int) -> np.ndarray:
        """Write the rows of the children that go on, in the children's order; returns how many each has."""
        n, until = len(feature), (bin_ + 1) * self.n_classes
        lo, hi = int(begins[0]), int(begins[-1])
        if n > 1 and hi - lo < SMALL_NODE * n:
            rows, sizes = np.asarray(self.rows[lo:hi]).astype(np.int64), np.diff(begins)
            codes = self.codes.reshape(-1).take(np.repeat(feature * self.codes.shape[1], sizes) + rows)
            side = np.repeat(2 * np.arange(n), sizes) + (codes >= np.repeat(until, sizes))
            inside = np.flatnonzero(keeps.ravel()[side])
            side = side[inside]
            ordered = rows[inside][np.argsort(side.astype(np.uint16), kind="stable")]
            self.spare[at : at + len(ordered)] = ordered
            return np.bincount(side, minlength=2 * n)[keeps.ravel()]
        sizes = []
        for i in range(n):
            for side in (0, 1):
                if not keeps[i, side]:
                    continue
                first = at
                for start in range(int(begins[i]), int(begins[i + 1]), PIECE):
                    rows = np.asarray(self.rows[start : min(start + PIECE, int(begins[i + 1]))])
                    found = rows[(self.codes[feature[i]].take(rows) >= until[i]) == bool(side)]
                    self.spare[at : at + len(found)] = found
                    at += len(found)
                sizes.append(at - first)
        return np.array(sizes, np.int64)

    def table(self) -> Iterator[pa.RecordBatch]:
        """The nodes in Spark's layout, children of equal prediction merged into their parent."""
        raw = np.concatenate(self.counts)
        counts = raw * self.of_class
        splits = np.concatenate([np.empty((0, 6)), *self.splits])
        n, guess = len(raw), counts.argmax(1)
        feature, bin_, children, gain = np.full(n, -1), np.zeros(n, np.int64), np.full((n, 2), -1), np.full(n, -1.0)
        of = splits[:, 0].astype(np.int64)
        feature[of], bin_[of], children[of], gain[of] = splits[:, 1], splits[:, 2], splits[:, 3:5], splits[:, 5]
        leaf, kept = children[:, 0] < 0, np.ones(n, bool)
        for node in of[np.argsort(-of, kind="stable")].tolist():
            a, b = children[node]
            if leaf[a] and leaf[b] and guess[a] == guess[b]:
                leaf[node], kept[a], kept[b] = True, False, False
        # A merged node's children are gone, and so are theirs: they were merged before it.
        new = np.cumsum(kept) - 1
        cuts = self.spec["cuts"]
        impurity, ids = _impurity(counts, self.spec["impurity"]), np.flatnonzero(kept)
        for start in range(0, len(ids), 1 << 13):
            some = ids[start : start + (1 << 13)]
            rows = []
            for i in some.tolist():
                inner = not leaf[i]
                split = {"featureIndex": int(feature[i]) if inner else -1, "leftCategoriesOrThreshold": [float(cuts[feature[i]][bin_[i]])] if inner else [], "numCategories": -1}
                rows.append({
                    "id": int(new[i]), "prediction": float(guess[i]), "impurity": float(impurity[i]), "impurityStats": counts[i].tolist(), "rawCount": int(raw[i].sum()),
                    "gain": float(gain[i]) if inner else -1.0, "leftChild": int(new[children[i, 0]]) if inner else -1, "rightChild": int(new[children[i, 1]]) if inner else -1, "split": split,
                })
            yield pa.RecordBatch.from_arrays([pa.array([self.number] * len(rows), pa.int32()), pa.array(rows, _NODE_TYPE)], ["treeID", "nodeData"])


_NODE_TYPE = pa.struct([
    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())), ("rawCount", pa.int64()), ("gain", pa.float64()),
    ("leftChild", pa.int32()), ("rightChild", pa.int32()),
    ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])),
])


def _trees(spec: dict[str, Any], begins: dict[tuple[int, int], int], n: int, n_tasks: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Write the blocks into one file of codes, feature by feature, and grow this task's trees over it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_features, kind, task = len(spec["cuts"]), np.dtype(spec["kind"]), TaskContext.get().partitionId()
        with tempfile.TemporaryDirectory(prefix="forest-") as folder:

            def file(name: str, dtype: Any, shape: tuple[int, ...]) -> np.ndarray:
                return np.memmap(f"{folder}/{name}", dtype, "w+", shape=shape)

            codes, got = file("codes", kind, (n_features, n)), 0
            for batch in batches:
                for i in range(batch.num_rows):
                    at, size = begins[batch["part"][i].as_py(), batch["number"][i].as_py()], batch["n"][i].as_py()
                    codes[:, at : at + size] = np.frombuffer(batch["codes"][i].as_buffer(), kind).reshape(n_features, size)
                    got += size
            if got != n:
                raise RuntimeError(f"a task got {got} of {n} rows")
            index = np.int32 if n < 1 << 31 else np.int64
            rows, spare, weight = file("rows", index, (n,)), file("spare", index, (n,)), file("weight", np.uint8, (n,))
            for number in range(task, spec["n_trees"], n_tasks):
                tree = _Tree(spec, number, *(np.asarray(x) for x in (codes, rows, spare, weight)))
                tree.grow()
                yield from tree.table()

    return run


def grow(forest: RandomForestClassifier, dataset: DataFrame, sizes: list[tuple[int, float]]) -> RandomForestClassificationModel:
    """Fit on all rows. ``sizes``: rows and weight of each class."""
    spark, n = dataset.sparkSession, sum(size for size, _ in sizes)
    n_trees, n_classes, weights = forest.getNumTrees(), len(sizes), [float(w) for _, w in sizes]
    rows = dataset.select(vector_to_array(F.col(forest.getFeaturesCol())).alias("x"), F.col(forest.getLabelCol()).cast("int").alias("y"))
    most = min(forest.getMaxBins(), n)
    found = rows.mapInArrow(_summaries(weights), "feature int, value double, weight double")
    by_feature = found.groupBy("feature").applyInArrow(_thresholds(most - 1), "feature int, cuts array<double>").toArrow().to_pylist()
    cuts = [np.array(r["cuts"], np.float64) for r in sorted(by_feature, key=lambda r: r["feature"])]
    n_bins = max(2, *(len(c) + 1 for c in cuts))
    kind = np.min_scalar_type(n_bins * n_classes - 1).str
    blocks = materialize(rows.mapInArrow(_blocks(cuts, n_classes, kind), "part int, number int, n int, codes binary"), "bins")
    begins, at = {}, 0
    for r in blocks.select("part", "number", "n").orderBy("part", "number").toArrow().to_pylist():
        begins[r["part"], r["number"]] = at
        at += r["n"]
    spec = {
        "seed": forest.getSeed() % (1 << 64), "n_trees": n_trees, "n_classes": n_classes, "weights": weights, "cuts": cuts, "n_bins": n_bins, "kind": kind,
        "n_tried": subset_size(forest.getFeatureSubsetStrategy(), len(cuts), n_trees), "max_depth": forest.getMaxDepth(), "rate": forest.getSubsamplingRate(),
        "impurity": forest.getImpurity().lower(), "min_rows": forest.getMinInstancesPerNode(), "min_gain": forest.getMinInfoGain(), "min_share": forest.getMinWeightFractionPerNode(),
    }
    # Every task gets all blocks, so there are no more tasks than keep the executors busy.
    slots = max(1, spark.sparkContext.defaultParallelism)
    n_tasks = min(n_trees, slots * math.ceil(8 / slots))
    dealt = blocks.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(n_tasks - 1)))).repartitionById(n_tasks, F.col("task")).drop("task")
    return _model(spark, forest, dealt.mapInArrow(_trees(spec, begins, n, n_tasks), NODE), len(cuts), n_classes)


def _model(spark: SparkSession, forest: RandomForestClassifier, nodes: DataFrame, n_features: int, n_classes: int) -> RandomForestClassificationModel:
    """Spark's model of the grown trees, by way of its own files."""
    place = shared_folder(spark, "forest")
    nodes.write.parquet(f"{place}/data")
    given, default = ({p.name: v for p, v in found.items()} for found in (forest._paramMap, forest._defaultParamMap))
    stamp = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}

    def described(kind: str, uid: str, without: tuple[str, ...], **more: int) -> str:
        params = {"paramMap": {k: v for k, v in given.items() if k not in without}, "defaultParamMap": {k: v for k, v in default.items() if k not in without}}
        return json.dumps({"class": f"org.apache.spark.ml.classification.{kind}", **stamp, "uid": uid, **params, **more})

    forests_only = ("numTrees", "featureSubsetStrategy", "subsamplingRate", "bootstrap")
    trees = [(i, described("DecisionTreeClassificationModel", f"dtc_{uuid.uuid4().hex[:12]}", forests_only, numFeatures=n_features, numClasses=n_classes), 1.0) for i in range(forest.getNumTrees())]
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{place}/treesMetadata")
    whole = described("RandomForestClassificationModel", forest.uid, (), numFeatures=n_features, numClasses=n_classes, numTrees=forest.getNumTrees())
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{place}/metadata")
    return RandomForestClassificationModel.load(place)
