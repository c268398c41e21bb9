"""Near-duplicate embeddings found on a robust-pruned flat graph.

Vectors are dealt to the ``OVERLAP`` nearest of some centres, so neighbouring shards
overlap. A shard over ``MOST`` vectors is dealt again to centres of its own, level by
level, so centres grow with the table; one that its centres do not divide is compared
block by block. In each shard every vector's nearest candidates are robust-pruned to a
bounded list of neighbours; the lists of all shards are united into one graph. A
search then starts at the shard's medoid, walks greedily towards each vector and,
once it is near, widens its range: every place within the threshold is expanded until
none is left. Links that were found are verified in double precision and joined to
components; inside a component all vectors are compared in blocks, which gives the exact number of
links of each. A bounded sample of vectors is compared with all others to measure the
recall, each vector counting once; while it is too low the shards overlap more, and in
the end all vectors of different components are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lapsekit.llm.components import components, named, smallest_ids
from lapsekit.llm.texts import mix
from lapsekit.session import materialize

SAMPLE, SHARD, MOST, CENTRES, OVERLAP = 8192, 600, 2000, 1024, 3
CANDIDATES, DEGREE, ALPHA, BEAM, SLACK = 48, 16, 1.2, 16, 0.05
AUDITED, WANTED, BLOCK = 512, 0.99, 1024
DRAWN, UNDIVIDED, FEW, SLAB = 2048, 0.75, 8, 4096


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of equal length as unit vectors; shorter rows are filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    size = np.diff(column.offsets.to_numpy())
    if not len(size):
        return np.zeros((0, 1))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (size == size[0]).all():
        out = flat.reshape(len(size), -1)
    else:
        out = np.zeros((len(size), size.max()))
        out[np.arange(size.max()) < size[:, None]] = flat
    scale = np.abs(out).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    out = out / np.where(scale > 0, scale, 1)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-300)


def _fit_width(x: np.ndarray, width: int) -> np.ndarray:
    return x[:, :width] if x.shape[1] >= width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def centres(sample: np.ndarray, k: int, rounds: int = 8, seed: int = 1) -> np.ndarray:
    """Spherical k-means of a sample."""
    rng = np.random.default_rng(seed)
    out = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)]
    for _ in range(rounds):
        near = (sample @ out.T).argmax(axis=1)
        total = np.zeros_like(out)
        np.add.at(total, near, sample)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        out = np.where(norm > 1e-12, total / np.maximum(norm, 1e-12), out)
    return out


def robust_prune(x: np.ndarray, candidates: int = CANDIDATES, degree: int = DEGREE, alpha: float = ALPHA) -> list[np.ndarray]:
    """Neighbours of each row: the nearest candidate stays, candidates much nearer to it than to the row go, and so on."""
    n = len(x)
    k = min(candidates, n - 1)
    if k < 1:
        return [np.zeros(0, np.int64)] * n
    near, gap = np.empty((n, k), dtype=np.int64), np.empty((n, k))
    for a in range(0, n, 512):
        sims = x[a : a + 512] @ x.T
        sims[np.arange(len(sims)), np.arange(a, a + len(sims))] = -9
        top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        near[a : a + 512] = top
        gap[a : a + 512] = 1 - np.take_along_axis(sims, top, axis=1)
    alive, chosen, rows = np.ones((n, k), dtype=bool), np.full((n, degree), -1, dtype=np.int64), np.arange(n)
    for d in range(degree):
        best = np.where(alive, gap, np.inf).argmin(axis=1)
        some = alive[rows, best]
        if not some.any():
            break
        pick = near[rows, best]
        chosen[some, d] = pick[some]
        for a in range(0, n, 512):
            between = 1 - np.einsum("nkd,nd->nk", x[near[a : a + 512]], x[pick[a : a + 512]])
            alive[a : a + 512] &= alpha * between > gap[a : a + 512]
        alive[rows, best] = False
    return [c[c >= 0] for c in chosen]


def range_search(x: np.ndarray, graph: np.ndarray, threshold: float, beam: int = BEAM, slack: float = SLACK) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, found row) within the threshold; ``graph`` lists each row's neighbours, filled with -1.

    All rows search at once, from the medoid: as long as one of a row's ``beam``
    nearest known places is unexpanded it is expanded, and so is every known place
    within ``slack`` of the threshold.
    """
    n = len(x)
    medoid = int((x @ x.mean(axis=0)).argmax())
    known = np.full((n, n), -2.0, dtype=np.float32)
    done = np.zeros((n, n), dtype=bool)
    known[:, medoid] = x @ x[medoid]
    active = np.arange(n)
    while len(active):
        here = known[active]
        edge = np.partition(here, -min(beam, n), axis=1)[:, -min(beam, n)]
        fresh = ~done[active] & (here > -2)
        walk = np.where(fresh & (here >= edge[:, None]), here, -3.0)
        best = walk.argmax(axis=1)
        go = fresh & (here >= threshold - slack)
        step = walk[np.arange(len(active)), best] > -3
        go[np.flatnonzero(step), best[step]] = True
        q, node = np.nonzero(go)
        if not len(q):
            break
        q = active[q]
        done[q, node] = True
        for a in range(0, len(q), 1 << 14):
            qs, to = q[a : a + (1 << 14)], graph[node[a : a + (1 << 14)]]
            qs, to = np.repeat(qs, to.shape[1]), to.reshape(-1)
            new = to >= 0
            qs, to = qs[new], to[new]
            new = known[qs, to] == -2
            at = np.unique(qs[new] * n + to[new])
            qs, to = at // n, at % n
            for b in range(0, len(at), 1 << 16):
                s = slice(b, b + (1 << 16))
                known[qs[s], to[s]] = np.einsum("nd,nd->n", x[qs[s]], x[to[s]])
        active = np.unique(q)
    a, b = np.nonzero(known >= threshold - 1e-4)
    return a[a != b], b[a != b]


def _assigned(middle: np.ndarray, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                top, sims = _nearest(_fit_width(_matrix(part.column("vector")), middle.shape[1]), middle, overlap)
                ids = np.repeat(part.column("id").to_numpy(), top.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(top.reshape(-1)), pa.array(sims.reshape(-1))], names=["id", "shard", "sim"])

    return run


def _nearest(x: np.ndarray, middle: np.ndarray, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centres of each row, and how near they are."""
    sims = x @ middle.T
    k = min(overlap, len(middle))
    top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    return top, np.take_along_axis(sims, top, axis=1)


def _own_centres(overlap: int, shard: int):
    def run(group: pa.Table) -> pa.Table:
        """Centres of one shard, from a sample of it."""
        group = group.sort_by("id")
        x, size = _matrix(group["vector"]), group["size"][0].as_py()
        k = int(min(max(4 * overlap, -(-size * overlap // shard)), max(2, len(x) // 4)))
        middle = centres(x, k)
        n, width = middle.shape
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width, dtype=np.int32)), pa.array(middle.reshape(-1)))
        return pa.table({"shard": pa.array(np.full(n, group["shard"][0].as_py())), "size": pa.array(np.full(n, size)), "place": pa.array(np.arange(n)), "middle": lists})

    return run


def _dealt_again(overlap: int):
    def run(rows: pa.Table, middles: pa.Table) -> pa.Table:
        """The nearest centres of a part of one shard among the shard's own."""
        if not rows.num_rows or not middles.num_rows:
            return pa.table({n: pa.array([], t) for n, t in (("id", pa.int64()), ("shard", pa.int64()), ("sim", pa.float64()), ("of", pa.int64()))})
        middles = middles.sort_by("place")
        flat = middles["middle"].combine_chunks()
        flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
        middle = flat.flatten().to_numpy().reshape(middles.num_rows, -1)
        top, sims = _nearest(_fit_width(_matrix(rows["vector"]), middle.shape[1]), middle, overlap)
        old, k = np.uint64(rows["shard"][0].as_py() & (2**64 - 1)), top.shape[1]
        new = mix(mix(np.array([old])) + top.reshape(-1).astype(np.uint64)).astype(np.int64)
        return pa.table({
            "id": pa.array(np.repeat(rows["id"].to_numpy(), k)), "shard": pa.array(new), "sim": pa.array(sims.reshape(-1)),
            "of": pa.array(np.repeat(rows["size"].to_numpy(), k)),
        })

    return run


def _whole(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        """Links among all vectors of a group of a few blocks, thinned to a spanning forest."""
        ids, x = group["id"].to_numpy(), _matrix(group["vector"])
        width = np.diff(pa.concat_arrays(group["vector"].chunks).offsets.to_numpy())
        n = len(ids)
        link = np.empty((n, n), dtype=bool)
        for a in range(0, n, BLOCK):
            link[a : a + BLOCK] = (x[a : a + BLOCK] @ x.T >= threshold) & (width[a : a + BLOCK, None] == width)
        np.fill_diagonal(link, False)
        label, fresh = np.arange(n), np.ones(n, dtype=bool)
        for start in np.flatnonzero(link.any(axis=1)):
            if not fresh[start]:
                continue
            front = np.array([start])
            fresh[start] = False
            while len(front):
                front = np.flatnonzero(link[front].any(axis=0) & fresh)
                fresh[front] = False
                label[front] = start
        linked = np.flatnonzero(label != np.arange(n))
        return pa.table({"a": pa.array(ids[linked]), "b": pa.array(ids[label[linked]])})

    return run


def _build(group: pa.Table) -> pa.Table:
    ids = group["id"].to_numpy()
    lists = robust_prune(_matrix(group["vector"]))
    size = np.array([len(c) for c in lists])
    to = ids[np.concatenate(lists)] if size.sum() else np.zeros(0, np.int64)
    offsets = pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32))
    return pa.table({"id": pa.array(ids), "near": pa.ListArray.from_arrays(offsets, pa.array(to, pa.int64()))})


def _search(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        """Links found in a shard, thinned to a spanning forest."""
        ids, x = group["id"].to_numpy(), _matrix(group["vector"])
        n = len(ids)
        order = np.argsort(ids)
        near = group["near"].combine_chunks()
        near = pa.concat_arrays(near.chunks) if isinstance(near, pa.ChunkedArray) else near
        size = np.diff(near.offsets.to_numpy())
        values = near.flatten().to_numpy()
        at = np.minimum(np.searchsorted(ids[order], values), n - 1)
        local = np.where(ids[order][at] == values, order[at], -1)
        owner = np.repeat(np.arange(n), size)
        owner, local = owner[local >= 0], local[local >= 0]
        count = np.bincount(owner, minlength=n)
        graph = np.full((n, max(1, count.max(initial=0))), -1, dtype=np.int64)
        graph[owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)] = local
        a, b = range_search(x, graph, threshold)
        width = np.diff(pa.concat_arrays(group["vector"].chunks).offsets.to_numpy()) if group["vector"].num_chunks else np.zeros(0)
        exact = np.concatenate([np.einsum("nd,nd->n", x[a[s : s + 65536]], x[b[s : s + 65536]]) for s in range(0, len(a), 65536)] or [np.zeros(0)])
        good = (exact >= threshold) & (width[a] == width[b])
        parent = np.arange(n)
        for i, j in zip(a[good].tolist(), b[good].tolist()):
            while parent[i] != i:
                parent[i] = i = parent[parent[i]]
            while parent[j] != j:
                parent[j] = j = parent[parent[j]]
            parent[max(i, j)] = min(i, j)
        for i in range(n):
            parent[i] = parent[parent[i]]
        linked = np.flatnonzero(parent != np.arange(n))
        return pa.table({"a": pa.array(ids[linked]), "b": pa.array(ids[parent[linked]])})

    return run


def _degrees(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        """Links of each vector inside its component, weighted by copies; one or two blocks at a time."""
        ids, n, side = group["id"].to_numpy(), group["n"].to_numpy(), group["side"].to_numpy()
        owner, x = np.unique(group["component"].to_numpy(), return_inverse=True)[1], _matrix(group["vector"])
        width = np.diff(pa.concat_arrays(group["vector"].chunks).offsets.to_numpy())
        order = np.argsort(owner, kind="stable")
        bounds = np.append(np.flatnonzero(np.diff(owner[order], prepend=-1)), len(order))
        total = np.zeros(len(ids), dtype=np.int64)
        for s, e in zip(bounds[:-1], bounds[1:]):
            rows = order[s:e]
            left, right = (rows[side[rows] == 0], rows[side[rows] == 1]) if side[rows].any() else (rows, rows)
            for a in range(0, len(left), BLOCK):
                part = left[a : a + BLOCK]
                link = (x[part] @ x[right].T >= threshold) & (width[part][:, None] == width[right]) & (ids[part][:, None] != ids[right])
                total[part] += link @ n[right]
                if right is not left:
                    total[right] += n[part] @ link
        return pa.table({"id": pa.array(ids), "links": pa.array(total)})

    return run


def _links_in_components(nodes: DataFrame, found: DataFrame, threshold: float) -> DataFrame:
    """``id, links`` for each node in a component; large components meet block by block."""
    members = nodes.join(found, "id").select("id", "n", "vector", "component")
    sizes = found.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = materialize(members.join(sizes, "component"), "members")
    bins = max(1, -(-members.count() // (2 * BLOCK)))
    small = members.where("blocks = 1").select(
        F.pmod(F.xxhash64("component"), F.lit(bins)).alias("g"), F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"),
        "component", "id", "n", "vector",
    )
    large = members.where("blocks > 1").withColumn("mine", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        (-1 - F.abs(F.col("component") / 2).cast("long")).alias("g"), F.least("mine", "other").alias("i"),
        F.greatest("mine", "other").alias("j"), (F.col("mine") > F.col("other")).cast("int").alias("side"), "component", "id", "n", "vector",
    )
    dealt = small.unionByName(large).groupBy("g", "i", "j", F.when(F.col("g") < 0, F.col("component")).alias("own"))
    return dealt.applyInArrow(_degrees(threshold), "id long, links long").groupBy("id").agg(F.sum("links").alias("links"))


def recall(nodes: DataFrame, links: DataFrame, threshold: float, audited: int = AUDITED) -> float:
    """Share of its links that a node of a bounded sample has in ``links``, against a comparison with all nodes.

    The mean over nodes, each with links counting once, or the mean over those with at most ``FEW`` links if that is lower.
    """
    asked = nodes.orderBy(F.xxhash64("id", F.lit(9))).limit(audited).select("id", "vector").toArrow()
    if not asked.num_rows:
        return 1.0
    ids, x, width = asked["id"].to_numpy(), _matrix(asked["vector"]), np.diff(pa.concat_arrays(asked["vector"].chunks).offsets.to_numpy())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ids), dtype=np.int64)
        for batch in batches:
            y = _fit_width(_matrix(batch.column("vector")), x.shape[1])
            same = width[:, None] == np.diff(batch.column("vector").offsets.to_numpy())
            hit = (x @ y.T >= threshold) & same & (ids[:, None] != batch.column("id").to_numpy())
            total += hit @ batch.column("n").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], names=["id", "links"])

    true = nodes.select("id", "n", "vector").mapInArrow(run, "id long, links long").groupBy("id").agg(F.sum("links").alias("true"))
    share = F.least("true", F.coalesce("links", F.lit(0))) / F.col("true")
    shares = true.where(F.col("true") > 0).join(links, "id", "left").select("true", share.alias("share"))
    row = shares.agg(F.avg("share"), F.avg(F.when(F.col("true") <= FEW, F.col("share")))).first()
    return min((v for v in row if v is not None), default=1.0)


def _completed(nodes: DataFrame, count: int, found: DataFrame, threshold: float) -> DataFrame:
    """``found`` after a comparison of every node with all nodes of other components, ``SLAB`` nodes at a time."""
    slabs = -(-count // SLAB)
    placed = nodes.select("id", "vector").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    placed = materialize(placed.withColumn("slab", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(slabs))), "slabs")

    def against(asked: pa.Table):
        ids, x, width = asked["component"].to_numpy(), _matrix(asked["vector"]), np.diff(pa.concat_arrays(asked["vector"].chunks).offsets.to_numpy())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(at, BLOCK)
                    y, mine = _matrix(part.column("vector")), part.column("component").to_numpy()
                    wide = max(x.shape[1], y.shape[1])
                    same = width[:, None] == np.diff(part.column("vector").offsets.to_numpy())
                    a, b = np.nonzero((_fit_width(x, wide) @ _fit_width(y, wide).T >= threshold) & same & (ids[:, None] != mine))
                    pairs = np.unique(np.stack([ids[a], mine[b]], axis=1), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        return run

    edges = found.select(F.col("id").alias("a"), F.col("component").alias("b"))
    for slab in range(slabs):
        asked = placed.where(F.col("slab") == slab).select("component", "vector").toArrow()
        if asked.num_rows:
            others = placed.where(F.col("slab") >= slab).select("component", "vector")
            edges = edges.unionByName(materialize(others.mapInArrow(against(asked), "a long, b long").distinct(), "missed"))
    return materialize(components(edges), "components")


def _placed(nodes: DataFrame, middle: np.ndarray, overlap: int, threshold: float) -> tuple[DataFrame, list[DataFrame]]:
    """``id, shard`` with all shards divided as far as their centres divide them, and links that hold the divided ones together."""
    vectors = nodes.select("id", "vector")
    placed = vectors.mapInArrow(_assigned(middle, overlap), "id long, shard long, sim double").withColumn("of", F.lit(1 << 62))
    placed, bridges = materialize(placed, "placed"), []
    while True:
        sizes = placed.groupBy("shard").agg(F.count("*").alias("size"), F.max("of").alias("most")).where(F.col("size") > MOST)
        split = materialize(sizes.where(F.col("size") <= UNDIVIDED * F.col("most")).select("shard", "size"), "oversize")
        if split.isEmpty():
            return placed.select("id", "shard"), bridges
        over = materialize(placed.join(split, "shard").select("id", "shard", "size").join(vectors, "id"), "oversize")
        drawn = over.where(F.pmod(F.xxhash64("id", "shard"), F.lit(1 << 20)) < F.lit(DRAWN) / F.col("size") * (1 << 20))
        middles = materialize(drawn.groupBy("shard").applyInArrow(_own_centres(overlap, SHARD), "shard long, size long, place long, middle array<double>"), "middles")
        bridges.append(drawn.select("id", "shard", "vector").groupBy("shard").applyInArrow(_whole(threshold), "a long, b long"))
        # Parts by hash only share out the work of dealing; each part meets all centres of its shard.
        parts = F.ceil(F.col("size") / MOST).cast("int")
        rows = over.withColumn("part", F.pmod(F.xxhash64("id", F.lit(11)), parts).cast("int"))
        middles = middles.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).select("shard", "part", "place", "middle")
        new = rows.groupBy("shard", "part").cogroup(middles.groupBy("shard", "part")).applyInArrow(_dealt_again(overlap), "id long, shard long, sim double, of long")
        best = F.slice(F.sort_array(F.collect_list(F.struct("sim", "shard", "of")), asc=False), 1, overlap)
        new = new.groupBy("id").agg(best.alias("best")).select("id", F.inline("best")).select("id", "shard", "sim", "of")
        placed = materialize(placed.join(split.select("shard"), "shard", "left_anti").unionByName(new), "placed")


def _links(nodes: DataFrame, middle: np.ndarray, overlap: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Components and numbers of links, from shards of the given overlap."""
    placed, bridges = _placed(nodes, middle, overlap, threshold)
    sizes = placed.groupBy("shard").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), (F.count("*") > MOST).alias("tight"))
    shards = materialize(placed.join(sizes, "shard").join(nodes.select("id", "vector"), "id"), "shards")
    loose = shards.where("not tight").select("shard", "id", "vector")
    graph = loose.groupBy("shard").applyInArrow(_build, "id long, near array<long>")
    graph = graph.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    edges = loose.join(graph, "id").groupBy("shard").applyInArrow(_search(threshold), "a long, b long")
    tight = shards.where("tight").withColumn("mine", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    tight = tight.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tight = tight.select("shard", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "id", "vector")
    edges = edges.unionByName(tight.groupBy("shard", "i", "j").applyInArrow(_whole(threshold), "a long, b long"))
    for more in bridges:
        edges = edges.unionByName(more)
    found = materialize(components(materialize(edges.distinct(), "links")), "components")
    return found, materialize(_links_in_components(nodes, found, threshold), "degrees")


def near_vectors(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors(vec_id, embedding)``.

    Vectors that are null, empty, zero or hold nulls or values that are not finite link
    with nothing; so do vectors of different lengths. A null ``vec_id`` has no links
    and no component and is not kept. Equal vectors are one node, weighted by its
    copies; rows that repeat an id are vectors of their own for ``n_links``, and one id for ``component_id``: whatever
    is reachable from one of them has the same component. Other columns are ignored.
    """
    value = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), value.alias("vector"))
    fine = "vector is not null and forall(vector, v -> v is not null and not isnan(v) and abs(v) < double('infinity')) and exists(vector, v -> v <> 0)"
    rows = rows.withColumn("ok", F.coalesce(F.expr(fine), F.lit(False)) & F.col("vec_id").isNotNull())
    rows = rows.withColumn("k1", F.xxhash64("vector")).withColumn("k2", F.xxhash64(F.lit(7), "vector"))
    nodes = rows.where("ok").groupBy("k1", "k2").agg(F.min("vec_id").alias("low"), F.count("*").alias("n"), F.first("vector").alias("vector"))
    nodes = named(materialize(nodes, "nodes"), "k1", "k2")
    count = nodes.count()
    keys = nodes.select("k1", "k2", "id", "n", "low")
    if count > 1:
        drawn = nodes.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < (2 * SAMPLE / count) * (1 << 20))
        sample = _matrix(drawn.orderBy(F.xxhash64("id")).limit(SAMPLE).select("vector").toArrow()["vector"])
        overlap = OVERLAP
        while True:
            k = int(min(CENTRES, max(1, -(-count * overlap // SHARD)), max(1, len(sample) // 4)))
            found, links = _links(nodes, centres(sample, k) if len(sample) else np.ones((1, 1)), overlap, threshold)
            if recall(nodes, links, threshold) >= WANTED:
                break
            if overlap >= 4 * OVERLAP:
                found = _completed(nodes, count, found, threshold)
                links = materialize(_links_in_components(nodes, found, threshold), "degrees")
                break
            overlap *= 2
        keys = keys.join(found, "id", "left").join(links, "id", "left")
    else:
        keys = keys.withColumn("component", F.col("id")).withColumn("links", F.lit(0))
    keys = keys.withColumn("component", F.coalesce("component", "id"))
    # Nodes are named by content; rows of one id may be several nodes, which joins their components.
    classes = smallest_ids(keys.select("component", "low"), rows.where("ok").join(keys.select("k1", "k2", "component"), ["k1", "k2"]).select("vec_id", "component"))
    keys = keys.join(classes, "component").select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "class", F.lit(True).alias("ok")
    )
    out = rows.select("vec_id", "k1", "k2", "ok").join(keys, ["k1", "k2", "ok"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("class", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
