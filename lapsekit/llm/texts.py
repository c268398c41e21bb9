"""Texts as flat byte arrays: every helper works on a whole Arrow batch at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES, PIECE_ROWS = 1 << 21, 1 << 12
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal inputs stay equal, others look independent."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = 0xD6E8FEB86659FD93
INVERSE = pow(BASE, -1, 1 << 64)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2^64; the longest list so far is kept."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, PIECE_BYTES + PIECE_BYTES // 8), base, dtype=np.uint64)
        known[:1] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(known, out=known)
        _POWERS[base] = known
    return known[:n]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column end to end, and where each row starts (null: empty)."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch holding about ``most`` bytes of text, one row at least and ``PIECE_ROWS`` at most."""
    if not batch.num_rows:
        return
    _, offsets = flat(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
        end = min(max(end, start + 1), start + PIECE_ROWS, batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of non-space bytes; a word never crosses rows."""
    inside = ~_SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[edges < len(data)]
    first[edges] = inside[edges]
    edges = edges[edges > 0]
    last[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, side="right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, from one running polynomial sum."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(BYTES[data] * powers(BASE, len(data)), out=total[1:])
        back = powers(INVERSE, len(data) + 1)
        return mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return _LOWER[data]


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and 52-bit hash of each distinct ``k``-word shingle, sorted by both.

    A row with fewer words is one shingle, its whole sequence; a row without words
    has none. At most ``PIECE_ROWS`` rows: row and hash share one sortable integer.
    """
    data, offsets = flat(column)
    data = lowered(data)
    starts, ends, row = words(data, offsets)
    if not len(starts):
        return row, np.zeros(0, np.uint64)
    word = span_hashes(data, starts, ends)
    count = np.bincount(row, minlength=len(column))
    begin = np.cumsum(count) - count
    with np.errstate(over="ignore"):
        value = mix(word * np.uint64(3))
        for i in range(1, k):
            value[: len(word) - i] = mix(value[: len(word) - i] * np.uint64(5) + word[i:])
        whole = np.arange(len(row)) - begin[row] + k <= count[row]
        for r in np.flatnonzero((count > 0) & (count < k)):
            at, n = begin[r], count[r]
            short = mix(word[at : at + 1] * np.uint64(7))
            for i in range(1, n):
                short = mix(short * np.uint64(5) + word[at + i])
            whole[at], value[at] = True, short[0]
    both = np.sort((row[whole].astype(np.uint64) << np.uint64(52)) | (value[whole] >> np.uint64(12)))
    new = np.ones(len(both), dtype=bool)
    new[1:] = both[1:] != both[:-1]
    both = both[new]
    return (both >> np.uint64(52)).astype(np.int64), both & np.uint64((1 << 52) - 1)
