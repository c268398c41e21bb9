"""Removal of long repeated byte strings by sharded suffix arrays.

Every byte that lies in a string of ``LENGTH`` bytes which also starts anywhere else
is removed. The work is dealt so that equal strings meet: each string is assigned to
its anchor, the smallest hash of the ``ANCHOR``-byte strings in it, which is the same
wherever the string stands. Neighbouring strings mostly share their anchor and travel as one
context. Anchors that occur once are dropped first.

Contexts are dealt into shards of bounded size. A shard is sorted by Larsson-Sadakane
refinement (ranks are doubled, and only groups that are still tied are sorted again),
Kasai's pass gives the common prefixes of neighbours, and strings that agree in
``LENGTH`` bytes are repeats. The contexts of an anchor too frequent for one shard are
dealt over several; every two of these are merged by binary search of one suffix array
in the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F

from lapsekit.llm.texts import BASE, BYTES, INVERSE, flat, mix, pieces, powers
from lapsekit.session import materialize

LENGTH, ANCHOR, SHARD_BYTES, BITS = 200, 40, 1 << 21, 26
#: Strings of a context at most, and bytes of one text that are looked at together.
STARTS, SEGMENT = 1 << 12, 1 << 21


def _anchor_hashes(data: np.ndarray, k: int) -> np.ndarray:
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(BYTES[data] * powers(BASE, len(data)), out=total[1:])
        return mix((total[k:] - total[:-k]) * powers(INVERSE, len(data) + 1)[: len(data) + 1 - k])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, k: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Hash, row, first string start (within all bytes) and number of string starts of each anchor's context, and
    whether its anchor stands at several places in it.

    Neighbouring strings stay in one context as long as their anchors are equal, wherever those stand, so periodic
    text is one context too; a context is cut after ``STARTS`` strings.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return none.astype(np.uint64), none, none, none, none.astype(bool)
    hashes, w = _anchor_hashes(data, k), length - k + 1
    low = np.uint64((1 << int(len(hashes)).bit_length()) - 1)
    key = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    blocks = -(-len(key) // w)
    padded = np.full(blocks * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(key)] = key
    padded = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(padded, axis=1).reshape(-1)
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    n = len(data) - length + 1
    least = np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])
    size = np.diff(offsets)
    ok = np.zeros(len(data) + 1, dtype=np.int32)
    long_ = size >= length
    np.add.at(ok, offsets[:-1][long_], 1)
    np.add.at(ok, offsets[1:][long_] - length + 1, -1)
    start = np.flatnonzero(np.cumsum(ok)[:n] > 0)
    if not len(start):
        return none.astype(np.uint64), none, none, none, none.astype(bool)
    place = (least[start] & low).astype(np.int64)
    anchor = hashes[place]
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)))
    begin = np.flatnonzero(new)
    new |= (np.arange(len(start)) - np.repeat(begin, np.diff(np.append(begin, len(start))))) % STARTS == 0
    begin = np.flatnonzero(new)
    moved = np.concatenate(([False], place[1:] != place[:-1])) & ~new
    first, count = start[new], np.diff(np.append(begin, len(start)))
    return anchor[new], np.searchsorted(offsets, first, side="right") - 1, first, count, np.add.reduceat(moved, begin) > 0


def _segments(column: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Bytes, row offsets and the place of the first byte in its row; a long text comes in parts that share ``length - 1`` bytes."""
    data, offsets = flat(column)
    if len(offsets) != 2 or len(data) <= SEGMENT + length:
        yield data, offsets, 0
        return
    for at in range(0, len(data) - length + 1, SEGMENT):
        part = data[at : at + SEGMENT + length - 1]
        yield part, np.array([0, len(part)]), at


def refine(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array, and the eight bytes at each place as one number."""
    n = len(data)
    padded = np.concatenate((data, np.zeros(8, np.uint8))).astype(np.uint64)
    words = np.zeros(n, dtype=np.uint64)
    for i in range(8):
        words = (words << np.uint64(8)) | padded[i : i + n]
    sa = np.argsort(words, kind="stable")
    head = np.concatenate(([True], words[sa[1:]] != words[sa[:-1]]))
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = -1
    rank[sa] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    h = 8
    while True:
        alone = head & np.append(head[1:], True)
        tied = np.flatnonzero(~alone)
        if not len(tied):
            break
        suffix = sa[tied]
        key = (rank[suffix] << 32) | (rank[np.minimum(suffix + h, n)] + 1)
        order = np.argsort(key, kind="stable")
        suffix, key = suffix[order], key[order]
        sa[tied] = suffix
        head[tied] = np.concatenate(([True], key[1:] != key[:-1]))
        first = np.maximum.accumulate(np.where(head[tied], tied, 0))
        rank[suffix] = first
        h *= 2
    return sa, words


def _extend(words: np.ndarray, a: np.ndarray, b: np.ndarray, common: np.ndarray, at: np.ndarray, cap: int) -> None:
    """Lengthen ``common[at]``, the known common prefix of suffixes ``a`` and ``b``, eight bytes at a time up to ``cap``."""
    n = len(words)
    while len(at):
        x, y = a[at] + common[at], b[at] + common[at]
        inside = (x < n) & (y < n)
        at, x, y = at[inside], x[inside], y[inside]
        differ = words[x] ^ words[y]
        same = differ == 0
        rest, more = at[~same], np.zeros((~same).sum(), dtype=np.int64)
        left = differ[~same]
        for i in range(7):
            more += left < (np.uint64(1) << np.uint64(56 - 8 * i))
        common[rest] += more
        common[at[same]] += 8
        at = at[same][common[at[same]] < cap]


def kasai(words: np.ndarray, sa: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of each sorted suffix with the one before, at least up to ``cap``.

    A suffix keeps all but one byte of its predecessor's common prefix; every 64th
    place is compared from scratch, the places between start from what they inherit.
    """
    n = len(sa)
    before = np.full(n, n, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    place, common = np.arange(n), np.zeros(n, dtype=np.int64)
    scratch = place[::64]
    _extend(words, place, before, common, scratch, cap + 64)
    reach = np.zeros(n, dtype=np.int64)
    reach[scratch] = common[scratch] + scratch
    others = np.ones(n, dtype=bool)
    others[scratch] = False
    inherited = np.maximum(np.maximum.accumulate(reach) - place, 0)
    common[others] = np.where(before[others] < n, inherited[others], 0)
    _extend(words, place, before, common, np.flatnonzero(others & (common < cap)), cap)
    return common[sa]


def search(words: np.ndarray, sa: np.ndarray, other: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For suffixes of another text: does a suffix listed in the sorted ``sa`` agree in ``length`` bytes. Binary search for all at once."""
    low, high = np.zeros(len(starts), dtype=np.int64), np.full(len(starts), len(sa), dtype=np.int64)

    def order(mid: np.ndarray, which: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as the suffix at ``mid`` is below, equal (in ``length`` bytes) or above."""
        out, at = np.zeros(len(which), dtype=np.int8), np.arange(len(which))
        for i in range(0, length, 8):
            x, y = words[sa[mid[at]] + i], other[starts[which[at]] + i]
            if length - i < 8:
                cut = np.uint64(8 * (8 - (length - i)))
                x, y = x >> cut, y >> cut
            out[at] = np.where(x < y, -1, np.where(x > y, 1, 0))
            at = at[x == y]
            if not len(at):
                break
        return out

    open_ = np.arange(len(starts))
    found = np.zeros(len(starts), dtype=bool)
    while len(open_):
        mid = (low[open_] + high[open_]) // 2
        o = order(mid, open_)
        found[open_[o == 0]] = True
        low[open_[o < 0]] = mid[o < 0] + 1
        high[open_[o > 0]] = mid[o > 0]
        open_ = open_[(o != 0) & (low[open_] < high[open_])]
    return found


def _shard(column: pa.Array, length: int):
    """Bytes, where each context starts and which places begin a whole string."""
    data, offsets = flat(column)
    valid = np.zeros(len(data) + 1, dtype=np.int32)
    np.add.at(valid, offsets[:-1], 1)
    np.add.at(valid, offsets[1:] - length + 1, -1)
    return data, offsets, np.cumsum(valid)[:-1] > 0


def _repeats(length: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        sides = [group.filter(pa.compute.equal(group["side"], s)).combine_chunks() for s in (0, 1)]
        built = []
        for side in sides:
            if side.num_rows:
                data, offsets, valid = _shard(side["context"].chunk(0), length)
                sa, words = refine(data)
                built.append((side, offsets, valid, sa, words))
        out = []
        for side, offsets, valid, sa, words in built:
            run_of = np.cumsum(kasai(words, sa, length) < length)
            use = valid[sa]
            often = np.bincount(run_of[use], minlength=int(run_of[-1]) + 1) > 1
            hit = np.zeros(len(valid), dtype=bool)
            hit[sa[use & often[run_of]]] = True
            out.append([side, offsets, valid, hit])
        if len(built) == 2:
            for me, (_, _, _, sa, words) in ((0, built[1]), (1, built[0])):
                valid_there = built[1 - me][2]
                starts = np.flatnonzero(out[me][2] & ~out[me][3])
                out[me][3][starts] = search(words, sa[valid_there[sa]], built[me][4], starts, length)
        tables = []
        for side, offsets, valid, hit in out:
            owner = np.searchsorted(offsets, np.arange(len(hit)), side="right") - 1
            edge = np.flatnonzero(hit & np.concatenate(([True], ~hit[:-1] | (owner[1:] != owner[:-1]))))
            stop = np.flatnonzero(hit & np.concatenate((~hit[1:] | (owner[1:] != owner[:-1]), [True]))) + 1
            row = pa.array(owner[edge])
            tables.append(pa.table({
                "h": side["h"].take(row), "c": side["c"].take(row), "a": pa.array((edge - offsets[owner[edge]]).astype(np.int32)),
                "b": pa.array((stop - offsets[owner[edge]]).astype(np.int32)),
            }))
        return pa.concat_tables(tables) if tables else pa.table({"h": pa.array([], pa.int64()), "c": pa.array([], pa.int64()), "a": pa.array([], pa.int32()), "b": pa.array([], pa.int32())})

    return run


def _counts(length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                for data, offsets, _ in _segments(part.column("text"), length):
                    h, _, _, _, several = anchors(data, offsets, length, k)
                    value, place = np.unique(h, return_inverse=True)
                    count = np.bincount(place, weights=1 + several, minlength=len(value)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(value.astype(np.int64)), pa.array(count)], names=["h", "n"])

    return run


def _contexts(length: int, k: int, bitmap: np.ndarray):
    mask = np.uint64(len(bitmap) * 64 - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                for data, offsets, at in _segments(part.column("text"), length):
                    found = _context_rows(part, data, offsets, at, length, k, bitmap, mask)
                    if found is not None:
                        yield found

    return run


def _context_rows(
    part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, at: int, length: int, k: int, bitmap: np.ndarray, mask: np.uint64
) -> pa.RecordBatch | None:
    """The contexts of the anchors that are in the bitmap."""
    h, row, first, count, several = anchors(data, offsets, length, k)
    bit = h & mask
    likely = (bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) > 0
    h, row, first, count, several = h[likely], row[likely], first[likely], count[likely], several[likely]
    if not len(h):
        return None
    size = count + length - 1
    ends = np.cumsum(size)
    bounds = np.concatenate(([0], ends)).astype(np.int32)
    place = np.arange(int(ends[-1])) + np.repeat(first - (ends - size), size)
    raw = data[place]
    context = pa.BinaryArray.from_buffers(pa.binary(), len(h), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(raw.tobytes())])
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTES[data] * powers(BASE, len(data)), dtype=np.uint64)))
    with np.errstate(over="ignore"):
        c = mix((total[first + size] - total[first]) * powers(INVERSE, len(data) + 1)[first] + size.astype(np.uint64))
    rows = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(h.astype(np.int64)), pa.array(c.astype(np.int64)), context, part.column("k1").take(rows), part.column("k2").take(rows),
            pa.array((at + first - offsets[row]).astype(np.int64)), pa.array(several),
        ],
        names=["h", "c", "context", "k1", "k2", "start", "several"],
    )


def _bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of the hashes, ``2 ** bits`` bits however many there are; a bit set in vain only costs a shuffled context."""
    rows = hashes.select(F.col("h").bitwiseAND(F.lit((1 << bits) - 1)).alias("bit"))
    rows = rows.selectExpr("shiftright(bit, 6) as word", "shiftleft(1L, cast(bit & 63 as int)) as mask")
    found = rows.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[found["word"].to_numpy()] = found["mask"].to_numpy().astype(np.int64).view(np.uint64)
    return out


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text without its removed stretches."""
    for batch in batches:
        out = []
        texts = batch.column("text").to_pylist()
        begins, ends = batch.column("begins").to_pylist(), batch.column("ends").to_pylist()
        for text, begin, end in zip(texts, begins, ends):
            raw = (text or "").encode()
            digest, at, removed, spans = hashlib.sha256(), 0, 0, 0
            reach = -1
            for a, b in sorted(zip(begin or (), end or ())):
                if a > reach:
                    spans += 1
                    digest.update(raw[at:a])
                    removed += b - a
                    at = reach = b
                elif b > reach:
                    removed += b - reach
                    at = reach = b
            digest.update(raw[at:])
            out.append((len(raw), removed, spans, digest.hexdigest()))
        columns = list(zip(*out)) or [()] * 4
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, kinds))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def repeated_stretches(texts: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, bits: int = BITS, shard: int = SHARD_BYTES) -> DataFrame:
    """``k1, k2, begins, ends``: stretches of each text of ``texts(k1, k2, text)`` that are covered by repeated strings.

    The two keys are hashes of the text; rows with equal texts count as occurrences of
    their own, and share the result. Stretches may touch or overlap.
    """
    counted = texts.select("text").mapInArrow(_counts(length, anchor), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    often = materialize(counted.where("n > 1").select("h"), "anchors")
    schema = "h long, c long, context binary, k1 long, k2 long, start long, several boolean"
    contexts = materialize(texts.mapInArrow(_contexts(length, anchor, _bitmap(often, bits)), schema), "contexts")

    distinct = materialize(contexts.groupBy("h", "c").agg(F.count("*").alias("n"), F.first("context").alias("context"), F.max("several").alias("several")), "distinct")
    sizes = distinct.groupBy("h").agg(F.count("*").alias("m"), F.sum(F.length("context")).alias("bytes"), F.max("several").alias("several"))
    mixed = materialize(sizes.where("m > 1 or several").withColumn("blocks", F.ceil(F.col("bytes") / shard).cast("int")), "mixed")
    total = mixed.agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, -(-total // shard))
    dealt = distinct.join(mixed.select("h", "blocks"), "h").select("h", "c", "context", "blocks")
    cold = dealt.where("blocks = 1").select(
        F.pmod(F.xxhash64("h"), F.lit(shards)).alias("g"), F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"), "h", "c", "context"
    )
    hot = dealt.where("blocks > 1").withColumn("mine", F.pmod(F.xxhash64("c"), "blocks").cast("int"))
    hot = hot.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        (-1 - F.abs(F.col("h") / 2).cast("long")).alias("g"), F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        (F.col("mine") > F.col("other")).cast("int").alias("side"), "h", "c", "context",
    )
    found = cold.unionByName(hot).groupBy("g", "i", "j").applyInArrow(_repeats(length), "h long, c long, a int, b int")
    whole = distinct.where("n > 1").select("h", "c", F.lit(0).alias("a"), (F.length("context") - length + 1).alias("b"))
    runs = materialize(found.unionByName(whole), "runs")

    places = contexts.groupBy("h", "c", "k1", "k2", "start").agg(F.count("*"))
    spans = places.join(runs, ["h", "c"]).select(
        "k1", "k2", (F.col("start") + F.col("a")).alias("begin"), (F.col("start") + F.col("b") - 1 + length).alias("end")
    )
    return spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("begin", "end")).alias("s")).select(
        "k1", "k2", F.col("s.begin").alias("begins"), F.col("s.end").alias("ends")
    )


def without_repeats(docs: DataFrame, length: int = LENGTH, **options: int) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for each row of ``docs(doc_id, text)``.

    A null text is empty; texts under ``length`` bytes keep everything; repeated rows
    repeat each other's bytes; a null ``doc_id`` is a document like others; other
    columns are ignored. Strings are judged on the input, not on what is left of it. A long
    text is looked at in segments of ``SEGMENT`` bytes; the periodic ones take no more than others.
    """
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(7), "text").alias("k2")
    )
    spans = repeated_stretches(base.where(F.octet_length("text") >= length).select("k1", "k2", "text"), length, **options)
    joined = base.join(materialize(spans, "spans"), ["k1", "k2"], "left")
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.select("doc_id", "text", "begins", "ends").mapInArrow(_digest, out)
