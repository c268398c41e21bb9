"""Sampled SentencePiece segmentations, and their lossless decoding.

A text is a lattice whose edges are the vocabulary pieces that occur in it. The
total weight of all segmentations up to each place is filtered forward, and one
segmentation is sampled backward from it, in proportion to the product of its
pieces' weights. The weight of a piece is its Zipf probability ``1 / (rank + 2)``
to the power of ``alpha``; the rank is what the model file states. A random number
depends on the seed, the row key and the place in the text only, so a row is
segmented alike on every run and partitioning.

No piece crosses from a word into the following space, so the lattice falls apart
at spaces and at characters outside all pieces. The forward pass is done once for each
distinct word of a slice of rows, the backward pass for each occurrence.

Decoding is lossless: spaces are the marker character, a marker in the text and
every character outside the vocabulary are spelled in byte pieces, nothing is
normalised and no dummy space is put in front.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F

from lapsekit.llm.texts import flat, mix, pieces

MARKER, ALPHA, SLICE_BYTES = 0x2581, 1.0, 1 << 18
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_STRANGE = 0x110000  # stands for a marker that the text itself holds
_BASE = np.uint64(0xD6E8FEB86659FD93)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Vocabulary:
    """The pieces as arrays; small enough to travel with the tasks."""

    hashes: np.ndarray  # sorted hashes of the pieces' code points
    ids: np.ndarray  # their ids
    weights: np.ndarray  # their log weights before alpha
    longest: int
    joins: np.ndarray  # per code point: is it part of a piece of two or more characters
    alone: np.ndarray  # per code point: the id of its own piece, or -1
    byte_ids: np.ndarray  # ids of the 256 byte pieces
    spelled: np.ndarray  # the bytes of all pieces end to end
    offsets: np.ndarray  # where each id starts in them
    bloom: np.ndarray

    @classmethod
    def load(cls, path: str = DEFAULT_MODEL) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=Path(path).read_bytes())
        n = model.get_piece_size()
        texts = [model.id_to_piece(i) for i in range(n)]
        usable = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int32)
        marker = chr(MARKER)
        if any(marker in texts[i].lstrip(marker) for i in usable):
            raise ValueError("a piece crosses from a word into a space")
        joins, alone = np.zeros(_STRANGE + 1, dtype=bool), np.full(_STRANGE + 1, -1, dtype=np.int32)
        for i in usable:
            if len(texts[i]) > 1:
                joins[[ord(c) for c in texts[i]]] = True
            else:
                alone[ord(texts[i])] = i
        joins &= alone >= 0
        usable = [i for i in usable if len(texts[i]) == 1 or joins[[ord(c) for c in texts[i]]].all()]
        points = [np.array([ord(c) for c in texts[i]], dtype=np.uint64) for i in usable]
        hashes = np.array([cls.hash_points(p) for p in points], dtype=np.uint64)
        order = np.argsort(hashes)
        rank = np.array([-model.get_score(i) for i in usable])
        spelled = [b""] * n
        for i in usable:
            spelled[i] = texts[i].replace(marker, " ").encode()
        for b, i in enumerate(byte_ids):
            spelled[i] = bytes([b])
        bloom = np.zeros(1 << 21, dtype=bool)
        bloom[(hashes >> np.uint64(43)).astype(np.int64)] = True
        return cls(
            hashes[order], np.array(usable, dtype=np.int32)[order], -np.log(np.maximum(rank, 0) + 2.0)[order], max(map(len, points)), joins,
            alone, byte_ids, np.frombuffer(b"".join(spelled), dtype=np.uint8), np.concatenate(([0], np.cumsum([len(s) for s in spelled]))), bloom,
        )

    @staticmethod
    def hash_points(points: np.ndarray) -> np.uint64:
        value, power = np.uint64(0), np.uint64(1)
        with np.errstate(over="ignore"):
            for c in mix(points + _GOLDEN):
                value, power = value + c * power, power * _BASE
        return mix(np.array([value + np.uint64(len(points))]))[0]


class _Lattices:
    """Lattices of several words at once, with the probability of each edge given its end."""

    def __init__(self, vocabulary: Vocabulary, points: np.ndarray, begin: np.ndarray, end: np.ndarray, alpha: float) -> None:
        size = end - begin
        word = np.repeat(np.arange(len(size)), size)
        offset = np.arange(len(points)) - np.repeat(begin, size)
        room = np.repeat(end, size) - np.arange(len(points))
        # Place p of word w is node p + w, so a word has one node more than characters.
        node = np.arange(len(points)) + word
        letters = mix(points.astype(np.uint64) + _GOLDEN)
        start, to, piece, width, at = [], [], [], [], np.arange(len(points))
        total, power = np.zeros(len(points), dtype=np.uint64), np.uint64(1)
        with np.errstate(over="ignore"):
            for n in range(1, vocabulary.longest + 1):
                at = at[room[at] >= n]
                if not len(at):
                    break
                total[at] += letters[at + n - 1] * power
                power = power * _BASE
                value = mix(total[at] + np.uint64(n))
                likely = np.flatnonzero(vocabulary.bloom[(value >> np.uint64(43)).astype(np.int64)])
                found = np.minimum(np.searchsorted(vocabulary.hashes, value[likely]), len(vocabulary.hashes) - 1)
                right = vocabulary.hashes[found] == value[likely]
                from_ = at[likely[right]]
                start.append(node[from_])
                to.append(node[from_] + n)
                piece.append(found[right])
                width.append(np.full(len(from_), n, dtype=np.int32))
        # Long pieces first: they are mostly the likelier ones, which the search below then meets sooner.
        start, to, piece, width = (np.concatenate(x[::-1]) for x in (start, to, piece, width))
        depth = np.zeros(len(points) + len(size), dtype=np.int64)
        depth[node + 1] = offset + 1
        order = np.argsort((depth[to] << 40) | to, kind="stable")
        start, to, piece, width = (x[order] for x in (start, to, piece, width))
        log_weight = alpha * vocabulary.weights[piece]
        level = np.searchsorted(depth[to], np.arange(1, int(size.max()) + 2))
        forward = np.zeros(len(points) + len(size))
        for a, b in zip(level[:-1], level[1:]):
            score = forward[start[a:b]] + log_weight[a:b]
            first = np.flatnonzero(np.concatenate(([True], to[a + 1 : b] != to[a : b - 1])))
            top = np.maximum.reduceat(score, first)
            spread = np.diff(np.append(first, b - a))
            forward[to[a:b][first]] = top + np.log(np.add.reduceat(np.exp(score - np.repeat(top, spread)), first))
        chance = np.exp(forward[start] + log_weight - forward[to])
        self.piece, self.width = vocabulary.ids[piece], width
        head = np.concatenate(([True], to[1:] != to[:-1]))
        self.first = np.zeros(len(points) + len(size), dtype=np.int64)
        self.first[to[head]] = np.flatnonzero(head)
        running = np.concatenate(([0.0], np.cumsum(chance)))
        self.limit = running[1:] - running[self.first[to]]
        self.limit[np.append(head[1:], True)] = 2.0
        self.node_begin = begin + np.arange(len(size))
        self.node_end = end + np.arange(len(size))


def _points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a text column end to end, spaces as markers, and each row's length."""
    rows = column.to_pylist()
    sizes = np.array([len(r) if r else 0 for r in rows], dtype=np.int64)
    joined = "".join(r for r in rows if r)
    points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).copy()
    points[points == MARKER] = _STRANGE
    points[points == 32] = MARKER
    return points, sizes


def sample(vocabulary: Vocabulary, column: pa.Array, keys: np.ndarray, seed: int, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids of one sampled segmentation of each text end to end, and how many each has."""
    points, sizes = _points(column)
    if not len(points):
        return np.zeros(0, np.int32), np.zeros(len(sizes), np.int64)
    row_end = np.cumsum(sizes)
    row = np.repeat(np.arange(len(sizes)), sizes)
    joins = vocabulary.joins[points]
    cut = np.ones(len(points), dtype=bool)
    cut[1:] = ((points[1:] == MARKER) & (points[:-1] != MARKER)) | ~joins[1:] | ~joins[:-1] | (row[1:] != row[:-1])
    begin = np.flatnonzero(cut)
    end = np.append(begin[1:], len(points))
    chosen = np.full(len(points), -2, dtype=np.int32)  # id of the piece that ends at each character
    single = end - begin == 1
    lone = begin[single]
    chosen[lone] = vocabulary.alone[points[lone]]
    begin, end = begin[~single], end[~single]
    if len(begin):
        letters = mix(points.astype(np.uint64) + _GOLDEN)
        with np.errstate(over="ignore"):
            first = np.repeat(begin, end - begin)
            at = np.cumsum(end - begin) - (end - begin)
            inner = np.arange(int((end - begin).sum())) - np.repeat(at, end - begin)
            word_hash = np.add.reduceat(mix(letters[first + inner] + inner.astype(np.uint64) * _GOLDEN), at)
        del letters, first, inner
        _, example, kind = np.unique(mix(word_hash + (end - begin).astype(np.uint64)), return_index=True, return_inverse=True)
        size = (end - begin)[example]
        stop = np.cumsum(size)
        inner = np.arange(int(stop[-1])) - np.repeat(stop - size, size)
        lattices = _Lattices(vocabulary, points[np.repeat(begin[example], size) + inner], stop - size, stop, alpha)
        with np.errstate(over="ignore"):
            salt = mix(keys.astype(np.uint64) * _GOLDEN + np.uint64(seed))[row[begin]]
            row_begin = (row_end - sizes)[row[begin]]
            node, until, at = lattices.node_end[kind], lattices.node_begin[kind], end.copy()
            while len(node):
                draw = (mix(salt + (at - row_begin).astype(np.uint64) * _BASE) >> np.uint64(11)) * (1.0 / (1 << 53))
                edge = lattices.first[node]
                over = np.flatnonzero(draw >= lattices.limit[edge])
                while len(over):
                    edge[over] += 1
                    over = over[draw[over] >= lattices.limit[edge[over]]]
                chosen[at - 1] = lattices.piece[edge]
                width = lattices.width[edge]
                node, at = node - width, at - width
                left = node > until
                node, until, at, salt, row_begin = node[left], until[left], at[left], salt[left], row_begin[left]
    ends = np.flatnonzero(chosen != -2)
    ids, owner = chosen[ends], row[ends]
    outside = np.flatnonzero(ids == -1)
    if len(outside):
        strange = points[ends[outside]]
        spelled = [chr(MARKER if c == _STRANGE else c).encode("utf-8", "surrogatepass") for c in strange.tolist()]
        repeat = np.ones(len(ids), dtype=np.int64)
        repeat[outside] = [len(s) for s in spelled]
        owner, wide = np.repeat(owner, repeat), np.repeat(ids, repeat)
        wide[wide == -1] = vocabulary.byte_ids[np.frombuffer(b"".join(spelled), dtype=np.uint8)]
        ids = wide
    return ids, np.bincount(owner, minlength=len(sizes))


def spell(vocabulary: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of lists of ids end to end, and where each list starts."""
    begin = vocabulary.offsets[ids]
    size = vocabulary.offsets[ids + 1] - begin
    ends = np.cumsum(size)
    place = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - (ends - size), size)
    bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
    return vocabulary.spelled[place], bounds


def _id_lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(ids))


def _keys(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(0).to_numpy().astype(np.int64)


def encode(docs: DataFrame, model: str = DEFAULT_MODEL, seed: int = 0, alpha: float = ALPHA) -> DataFrame:
    """``doc_id, n_pieces, ids, lossless`` for each row of ``docs(doc_id, text)``.

    ``lossless`` says whether the ids spell the text byte for byte. A null text has
    null ids, no pieces and is lossless; an empty text has an empty list; a null
    ``doc_id`` draws like key 0. Rows that repeat a key and text get the same ids.
    Other columns are ignored.
    """
    vocabulary = Vocabulary.load(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", SLICE_BYTES):
                text = part.column("text")
                ids, counts = sample(vocabulary, text, _keys(part.column("doc_id")), seed, alpha)
                again, bounds = spell(vocabulary, ids, counts)
                data, offsets = flat(text)
                if len(again) == len(data):
                    wrong = np.concatenate(([0], np.cumsum(again != data)))
                    same = (np.diff(bounds) == np.diff(offsets)) & (wrong[offsets[1:]] == wrong[offsets[:-1]])
                else:
                    same = np.array([
                        np.array_equal(again[bounds[i] : bounds[i + 1]], data[offsets[i] : offsets[i + 1]]) for i in range(len(counts))
                    ])
                lists = _id_lists(ids, counts)
                if text.null_count:
                    lists = pa.compute.if_else(text.is_valid(), lists, None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.int64()), lists, pa.array(same)], names=["doc_id", "n_pieces", "ids", "lossless"]
                )

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return base.mapInArrow(run, "doc_id long, n_pieces long, ids array<int>, lossless boolean")


def decode(encoded: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """``doc_id, text`` from ``encoded(doc_id, ids)``; null ids give a null text, byte runs that are no UTF-8 the replacement sign."""
    vocabulary = Vocabulary.load(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            counts = np.diff(lists.offsets.to_numpy())
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            counts = np.where(lists.is_valid().to_numpy(zero_copy_only=False), counts, 0)
            data, bounds = spell(vocabulary, ids, counts)
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8", "replace") if ok else None for a, b, ok in zip(bounds[:-1], bounds[1:], lists.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")
