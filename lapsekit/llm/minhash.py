"""Near-duplicate documents by fast similarity sketching.

A sketch has ``COORDINATES`` bins. In round ``i`` every shingle of a set is thrown
into one hashed bin with value ``i + hash``, and a bin keeps its smallest value;
from round ``COORDINATES`` on, round ``i`` throws all shingles into bin
``i - COORDINATES``. A set stops as soon as all its bins are filled, which
guarantees that each coordinate is filled and that the share of equal coordinates
is concentrated around the Jaccard similarity even for small sets. Bands of the
sketch propose pairs and the full sets decide.

A pair at similarity 0.8 shares none of the 32 bands of five coordinates with a
probability of ``(1 - 0.8 ** 5) ** 32``, about 3 in a million.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lapsekit.llm.components import components, named, smallest_ids
from lapsekit.llm.idfilter import only_ids
from lapsekit.llm.texts import mix, pieces, shingle_sets
from lapsekit.session import materialize

COORDINATES, BAND = 160, 5
SMALL, BLOCK_ITEMS, SLICE_BYTES = 6, 1 << 20, 1 << 20
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_GOLDEN = 0x9E3779B97F4A7C15


def _salt(i: int) -> np.uint64:
    return np.uint64((i + 1) * _GOLDEN % (1 << 64))


def sketch(row: np.ndarray, value: np.ndarray, n: int, t: int = COORDINATES) -> np.ndarray:
    """Sketches of ``n`` sets given as (row, hash) pairs; rows without elements stay empty."""
    bins = np.full((n, t), _EMPTY, dtype=np.uint64)
    line = bins.reshape(-1)
    for i in range(2 * t):
        if not len(row):
            break
        draw = mix(value ^ _salt(i))
        where = (draw % np.uint64(t)).astype(np.int64) if i < t else np.full(len(row), i - t)
        rank = (np.uint64(i) << np.uint64(52)) | (mix(draw) >> np.uint64(12))
        np.minimum.at(line, row * t + where, rank)
        if i >= 2:
            open_rows = np.zeros(n, dtype=bool)
            held = row[np.concatenate(([True], row[1:] != row[:-1]))]
            open_rows[held] = (bins[held] == _EMPTY).any(axis=1)
            left = open_rows[row]
            row, value = row[left], value[left]
    return bins


def _bands(bins: np.ndarray, band: int) -> np.ndarray:
    n, t = bins.shape
    out = np.zeros((n, t // band), dtype=np.uint64)
    with np.errstate(over="ignore"):
        out += np.arange(t // band, dtype=np.uint64) * np.uint64(_GOLDEN)
        for j in range(band):
            out = mix(out * np.uint64(3) + bins[:, j::band][:, : t // band])
    return out.astype(np.int64)


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int64)))


def _sketches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", SLICE_BYTES):
                n = part.num_rows
                row, value = shingle_sets(part.column("text"), k)
                size = np.bincount(row, minlength=n)
                digest = _digests(value, size)
                bands = _bands(sketch(row, value, n), BAND)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(size, pa.int64()), *digest,
                        _lists(bands.reshape(-1), np.full(n, bands.shape[1])),
                    ],
                    names=["doc_id", "n_shingles", "d1", "d2", "bands"],
                )

    return run


def _digests(value: np.ndarray, size: np.ndarray) -> list[pa.Array]:
    """Two independent 64-bit sums over each set."""
    out, end = [], np.cumsum(size)
    for salt in (11, 13):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(value ^ _salt(salt)), dtype=np.uint64)))
        out.append(pa.array((total[end] - total[end - size]).astype(np.int64)))
    return out


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", SLICE_BYTES):
                row, value = shingle_sets(part.column("text"), k)
                size = np.bincount(row, minlength=part.num_rows)
                columns = [pa.array(size, pa.int64()), *_digests(value, size), _lists(value, size)]
                yield pa.RecordBatch.from_arrays(columns, names=["n_shingles", "d1", "d2", "items"])

    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Pairs whose full sets have ``100 * intersection >= threshold * union``."""
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    total = F.size("x") + F.size("y") - common
    joined = pairs.join(right, "b").join(left, "a")
    return joined.where(100 * common >= threshold * total).select("a", "b")


def _small(open_: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links between different components inside small buckets, from their few pairs."""
    few = open_.where(F.col("c") <= SMALL)
    left = few.select("key", F.col("id").alias("a"), F.col("component").alias("x"))
    right = few.select("key", F.col("id").alias("b"), F.col("component").alias("y"))
    pairs = left.join(right, "key").where("a < b and x <> y").select("a", "b").distinct()
    return _confirmed(pairs, sets, threshold)


def _across(threshold: int):
    def run(group: pa.Table) -> pa.Table:
        """Links that join components of one block; members of the largest component are only compared with others."""
        group = group.combine_chunks()
        ids, owner = group["id"].to_numpy(), group["component"].to_numpy()
        items = group["items"].combine_chunks()
        starts = items.offsets.to_numpy()
        codes = np.unique(items.values.to_numpy()[starts[0] : starts[-1]], return_inverse=True)[1]
        starts = starts - starts[0]
        size = np.diff(starts)
        names, local = np.unique(owner, return_inverse=True)
        parent = list(range(len(names)))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = i = parent[parent[i]]
            return i

        a, b = [], []
        held = np.zeros(codes.max(initial=0) + 1, dtype=np.int32)
        for i in np.flatnonzero(local != np.bincount(local).argmax()):
            mine = codes[starts[i] : starts[i + 1]]
            held[mine] = 1
            common = np.add.reduceat(held[codes], starts[:-1])
            held[mine] = 0
            for j in np.flatnonzero((100 * common >= threshold * (size + size[i] - common)) & (local != local[i])):
                x, y = root(local[i]), root(local[j])
                if x != y:
                    parent[x] = y
                    a.append(ids[i])
                    b.append(ids[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _large(open_: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links between different components inside large buckets.

    A bucket is dealt into blocks of about ``BLOCK_ITEMS`` shingles, and every two
    blocks meet in one task, which compares in place and returns one link for each
    two components it joins: no pair is left out and none is written.
    """
    many = open_.where(F.col("c") > SMALL).join(sets, "id")
    blocks = many.groupBy("key").agg(F.ceil(F.sum(F.size("items")) / BLOCK_ITEMS).cast("int").alias("blocks"))
    dealt = many.join(blocks, "key").withColumn("i", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    dealt = dealt.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("key", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "id", "component", "items")
    return dealt.groupBy("key", "i", "j").applyInArrow(_across(threshold), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 5, threshold: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs(doc_id, text)``.

    Rows with equal sets are one node, so a group of copies of any size costs one
    sketch. Inside a bucket all members are first checked against its most central
    one. Only buckets whose members are then still in different components are
    looked at again, and there only members of different components are compared.

    Nulls and empty texts have no shingles and are linked with nothing. A null
    ``doc_id`` is linked with nothing, has no component and is not kept. Rows that
    repeat a ``doc_id`` are one document: what is linked with one of its texts is linked with all, and the
    rows have one component; ``n_shingles`` is each row's own. Very long texts are taken whole, with about 100 bytes
    of arrays per byte. Other columns are ignored.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>"
    rows = materialize(base.mapInArrow(_sketches(shingle), schema), "sketches")
    digest = ["n_shingles", "d1", "d2"]
    usable = rows.where("n_shingles > 0 and doc_id is not null")
    nodes = usable.groupBy(*digest).agg(F.min("doc_id").alias("low"), F.first("bands").alias("bands"))
    nodes = named(materialize(nodes, "nodes"), *digest)
    placed = nodes.select("id", F.explode("bands").alias("key"))
    buckets = placed.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    placed = materialize(placed.join(buckets, "key"), "placed")
    # The member that meets most others is nearest to the text they were all made from: the best one to check first.
    met = placed.groupBy("id").agg(F.sum("c").alias("met"))
    placed = placed.join(met, "id").withColumn("rank", F.struct("met", -F.col("id")))
    pivots = placed.groupBy("key").agg((-F.max("rank")["col2"]).alias("pivot"))
    members = materialize(placed.select("key", "id", "c").join(pivots, "key"), "members")
    # Only the texts of bucket members are shuffled for their sets.
    wanted = materialize(members.select("id").distinct().join(nodes.select("id", "low", *digest), "id"), "wanted")
    texts = only_ids(base, wanted.select(F.col("low").alias("id")).distinct())
    lists = texts.mapInArrow(_sets(shingle), "n_shingles long, d1 long, d2 long, items array<long>")
    # A repeated id brings other texts and a repeated row the same one: one set per node stays. Lists are shuffled once.
    sets = lists.groupBy(*digest).agg(F.first("items").alias("items")).join(wanted.select("id", *digest), digest)
    sets = materialize(sets.select("id", "items"), "sets")

    stars = members.where("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    links = materialize(_confirmed(stars, sets, threshold), "links")
    found = materialize(components(links), "components")

    labelled = members.join(found, "id", "left").select("key", "c", "id", F.coalesce("component", "id").alias("component"))
    split = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    open_ = materialize(labelled.join(split.select("key"), "key", "left_semi"), "open")
    final = components(links.unionByName(_small(open_, sets, threshold)).unionByName(_large(open_, sets, threshold)))

    placed = nodes.select(*digest, "id", "low").join(final, "id", "left").withColumn("component", F.coalesce("component", "id"))
    placed = materialize(placed.select(*digest, "low", "component"), "classes")
    members = usable.select("doc_id", *digest).join(placed.select(*digest, "component"), digest).select("doc_id", "component")
    classes = placed.select(*digest, "component").join(smallest_ids(placed.select("component", "low"), members), "component")
    same = rows.select("doc_id", *digest).join(classes.select(*digest, "class"), digest, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("class", "doc_id"))
    return same.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )
