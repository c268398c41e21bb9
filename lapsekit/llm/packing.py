"""Documents packed into sequences of a fixed number of tokens.

Which pieces go together depends on their lengths alone, so the plan is made from
one count per length (as many as a sequence has tokens, however large the table):

1. Linear grouping. Pieces longer than a share of a sequence are put in order of
   length and cut into groups of equally many; each counts with its group's largest
   length, which leaves a few dozen sizes.
2. Configurations of those sizes are found by column generation: a simplex step on the
   sizes, a knapsack for the next column. Their numbers are rounded down.
3. Substitution. The places of a group are taken by its real pieces, which are never longer.
4. What is left, all small pieces above all, goes to the fullest sequence it fits in
   (best fit, longest first), a whole class of equal sequences at a time.

Several group numbers and shares are planned and the plan with the fewest sequences
is used. A plan is a table of rank ranges per length; each piece looks up its own
rank, so no piece is moved to be placed.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from lapsekit.session import materialize

CAPACITY, END_ID = 2048, 0
DEFAULT_TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
#: Shares of a sequence above which a piece is large, and numbers of groups, that are tried.
TRIED = [(2, 64), (3, 64), (5, 64), (3, 192)]
KNOWN_WORDS, KNOWN_BYTES, SLICE = 1 << 19, 64, 1 << 20
_LETTERS = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]?)")
_SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]")


# ---- token ids


class WordTokenizer:
    """Ids of whole texts, for tokenizers whose normaliser and pre-tokenizer never look across white space.

    A text is cut at ASCII white space; each word is encoded by the tokenizer once and
    remembered (``KNOWN_WORDS`` at most, short ones only). Texts that hold one of the
    tokenizer's added tokens are encoded whole, as those may span words.
    """

    def __init__(self, definition: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model = Tokenizer.from_str(definition)
        self.model.no_truncation()
        self.model.no_padding()
        self.added = [t.content.encode() for t in self.model.get_added_tokens_decoder().values()]
        self.known: dict[bytes, bytes] = {}
        before, norm = self.model.pre_tokenizer, self.model.normalizer
        self.letters_alone = (
            before is not None and norm is not None and norm.normalize_str("AbZÀÖØÞß") == "abzàöøþß"
            and [p for p, _ in before.pre_tokenize_str("ab,")] == ["ab", ","]
        )
        # How the pre-tokenizer spells each accented letter.
        self.spelling = {c: before.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100) if c != 0xF7} if self.letters_alone else {}

    def _learn(self, new: list[bytes]) -> None:
        """Remember the ids of new words. Where the tokenizer lowers letters and parts them from the sign
        behind (probed above), Latin words go straight to its model."""
        known, tokenize, rest = self.known, self.model.model.tokenize, []
        for word in new:
            text = word.decode()
            match = _LETTERS.fullmatch(text) if self.letters_alone else None
            if match is None:
                rest.append((word, text))
            else:
                ids = [t.id for t in tokenize(match[1].lower().translate(self.spelling))]
                if match[2]:
                    ids += [t.id for t in tokenize(match[2])]
                known[word] = array("I", ids).tobytes()
        if rest:
            encoded = self.model.encode_batch_fast([text for _, text in rest], add_special_tokens=False)
            known.update((word, array("I", e.ids).tobytes()) for (word, _), e in zip(rest, encoded))

    def _words(self, words: list[bytes]) -> bytes:
        known = self.known
        new = list(set(words).difference(known))
        if new:
            self._learn(new)
        out = b"".join(map(known.__getitem__, words))
        for word in new:
            if len(word) > KNOWN_BYTES:
                del known[word]
        if len(known) > KNOWN_WORDS:
            known.clear()
        return out

    def ids(self, text: bytes) -> bytes:
        """The ids of a text given in UTF-8, four bytes each."""
        if any(mark in text for mark in self.added):
            return array("I", self.model.encode(text.decode(), add_special_tokens=False).ids).tobytes()
        parts, at = [], 0
        while at < len(text):
            end = at + SLICE
            if end < len(text):
                cut = _SPACE.search(text, end)
                end = cut.start() if cut else len(text)
            parts.append(self._words(text[at:end].split()))
            at = end
        return b"".join(parts)


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(definition: str) -> WordTokenizer:
    """One tokenizer per worker: what it has learned serves later tasks too."""
    if definition not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[definition] = WordTokenizer(definition)
    return _TOKENIZERS[definition]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str = DEFAULT_TOKENIZER, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """Token pieces of ``docs(doc_id, text)``: ``doc_id, piece, start, length, ids_crc32, ids``.

    ``with_ids=False`` leaves the ids themselves out, where lengths and digests are enough.

    A document is its ids followed by id 0. Documents of up to ``capacity`` ids are one
    piece, longer ones are cut every ``capacity`` ids. A null or empty text is the single
    id 0; a null ``doc_id`` stays null; repeated rows are documents of their own; other
    columns are ignored; an empty table has no pieces. Very long texts are encoded slice by
    slice and held as four bytes a token.
    """
    with open(tokenizer, encoding="utf-8") as file:
        definition = file.read()
    schema = PIECES + (", ids array<int>" if with_ids else "")
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _tokenizer(definition)
        rows: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            doc, piece, start, ids = zip(*rows)
            size = np.array([len(x) for x in ids])
            columns = [
                pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()),
                pa.array([zlib.crc32(x) for x in ids], pa.int64()),
            ]
            if with_ids:
                offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32))))
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
                found = model.ids(text.as_py() or b"") + END_ID.to_bytes(4, sys.byteorder)
                ids = np.frombuffer(found, dtype=np.uint32).astype("<u4", copy=False)
                for i, at in enumerate(range(0, len(ids), capacity)):
                    rows.append((doc, i, at, ids[at : at + capacity]))
                    held += min(capacity, len(ids) - at)
                    if held >= 1 << 20:
                        yield flush()
                        held = 0
        if rows:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


# ---- the plan: from counts per length to rank ranges


def _groups(counts: np.ndarray, least: int, number: int) -> tuple[np.ndarray, list[deque]]:
    """Rounded sizes, longest first, and the real lengths behind each as ``[length, count]``."""
    total = int(counts[least:].sum())
    sizes: list[int] = []
    members: list[deque] = []
    taken = 0
    for length in range(len(counts) - 1, least - 1, -1):
        left = int(counts[length])
        while left:
            g = taken * number // total
            room = -(-(g + 1) * total // number) - taken
            if not members or g != group:
                group = g
                if not sizes or sizes[-1] != length:
                    sizes.append(length)
                    members.append(deque())
            t = min(left, room)
            if members[-1] and members[-1][-1][0] == length:
                members[-1][-1][1] += t
            else:
                members[-1].append([length, t])
            taken += t
            left -= t
    return np.array(sizes, dtype=np.int64), members


def _best_column(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> np.ndarray:
    """The configuration of greatest worth: a knapsack with repetition, one more piece per layer."""
    best, layers = np.zeros(capacity + 1), []
    before = np.arange(capacity + 1) - sizes[:, None]
    for _ in range(capacity // int(sizes.min())):
        with_it = np.where(before >= 0, best[before] + worth[:, None], -1.0)
        choice = with_it.argmax(axis=0)
        value = with_it[choice, np.arange(capacity + 1)]
        better = value > best + 1e-12
        if not better.any():
            break
        layers.append(np.where(better, choice, -1))
        best = np.where(better, value, best)
    column, at = np.zeros(len(sizes)), capacity
    for choice in reversed(layers):
        if choice[at] >= 0:
            column[choice[at]] += 1
            at -= sizes[choice[at]]
    return column


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often each is used, rounded down from the linear optimum."""
    basis = np.diag((capacity // sizes).astype(float))
    for _ in range(20 * len(sizes)):
        worth = np.linalg.solve(basis.T, np.ones(len(sizes)))
        column = _best_column(sizes, worth, capacity)
        if worth @ column <= 1 + 1e-7:
            break
        step = np.linalg.solve(basis, column)
        amount = np.linalg.solve(basis, demand.astype(float))
        ratio = np.full(len(sizes), np.inf)
        usable = step > 1e-9
        ratio[usable] = np.maximum(amount[usable], 0) / step[usable]
        basis[:, int(ratio.argmin())] = column
    amount = np.linalg.solve(basis, demand.astype(float))
    return [(basis[:, j].astype(np.int64), int(max(amount[j], 0) + 1e-6)) for j in range(len(sizes))]


class _Sequences:
    """Classes of equal sequences by free room. A class is (how many, its pieces); pieces are
    (length, copies in each sequence, first rank): sequence ``i`` of the class has the ranks from
    ``first + i * copies`` on."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.by_room: list[list[tuple[int, tuple]]] = [[] for _ in range(capacity + 1)]
        self.ranks = np.zeros(capacity + 1, dtype=np.int64)

    @staticmethod
    def split(content: tuple, at: int) -> tuple:
        return tuple((length, k, first + at * k) for length, k, first in content)

    def add(self, number: int, room: int, content: tuple) -> None:
        if number:
            self.by_room[room].append((number, content))

    def take(self, length: int, number: int) -> int:
        first = int(self.ranks[length])
        self.ranks[length] += number
        return first

    def fill(self, configuration: np.ndarray, times: int, members: list[deque]) -> None:
        """Real pieces take the places of a configuration; groups that run out leave room."""
        parts = [(times, self.capacity, ())]
        for g in np.flatnonzero(configuration):
            for _ in range(configuration[g]):
                after = []
                for number, room, content in parts:
                    done = 0
                    while done < number and members[g]:
                        head = members[g][0]
                        t = min(number - done, head[1])
                        piece = (head[0], 1, self.take(head[0], t))
                        after.append((t, room - head[0], (*self.split(content, done), piece)))
                        head[1] -= t
                        done += t
                        if not head[1]:
                            members[g].popleft()
                    if done < number:
                        after.append((number - done, room, self.split(content, done)))
                parts = after
        for number, room, content in parts:
            if content:
                self.add(number, room, content)

    def best_fit(self, length: int, number: int) -> None:
        room = length
        while number:
            while room < self.capacity and not self.by_room[room]:
                room += 1
            if self.by_room[room]:
                have, content = self.by_room[room].pop()
            else:
                have, content = number, ()
            k = room // length
            full = min(have, number // k)
            if full:
                piece = (length, k, self.take(length, full * k))
                self.add(full, room - k * length, (*content, piece))
                number -= full * k
            rest = number if number < k and full < have else 0
            if rest:
                piece = (length, rest, self.take(length, rest))
                self.add(1, room - rest * length, (*self.split(content, full), piece))
                number = 0
            left = have - full - bool(rest)
            if content:
                self.add(left, room, self.split(content, full + bool(rest)))

    def count(self) -> int:
        return sum(number for held in self.by_room for number, _ in held)

    def slots(self) -> np.ndarray:
        """Rows of length, first rank, copies, first sequence and offset, in order of length and rank."""
        out, sequence = [], 0
        for held in self.by_room:
            for number, content in held:
                at = 0
                for length, k, first in content:
                    out.append((length, first, k, sequence, at))
                    at += k * length
                sequence += number
        found = np.array(out, dtype=np.int64).reshape(-1, 5)
        return found[np.lexsort((found[:, 1], found[:, 0]))]


def _planned(counts: np.ndarray, share: int, number: int) -> _Sequences:
    capacity = len(counts) - 1
    plan, left = _Sequences(capacity), counts.copy()
    least = capacity // share + 1
    if counts[least:capacity].any():
        large = counts.copy()
        large[capacity] = 0
        sizes, members = _groups(large, least, number)
        demand = np.array([sum(c for _, c in m) for m in members])
        for configuration, times in configurations(sizes, demand, capacity):
            plan.fill(configuration, times, members)
        left = counts - plan.ranks
    for length in range(capacity, 0, -1):
        if left[length]:
            plan.best_fit(length, int(left[length]))
    return plan


def plan_sequences(counts: np.ndarray) -> tuple[int, np.ndarray]:
    """The number of sequences and the slots for ``counts[length]`` pieces of each length up to the capacity."""
    counts = np.asarray(counts, dtype=np.int64)
    capacity = len(counts) - 1
    bound = -(-int(counts @ np.arange(capacity + 1)) // capacity)
    best = None
    for share, number in TRIED:
        plan = _planned(counts, share, number)
        if best is None or plan.count() < best.count():
            best = plan
        if best.count() == bound:
            break
    return best.count(), best.slots()


# ---- placing


def _numbered(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each task numbers its own pieces of a length."""
        task = TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            order = np.argsort(lengths, kind="stable")
            value, first, count = np.unique(lengths[order], return_index=True, return_counts=True)
            local = np.empty(len(lengths), dtype=np.int64)
            before = np.array([seen.get(v, 0) for v in value.tolist()], dtype=np.int64)
            local[order] = np.arange(len(lengths)) - np.repeat(first - before, count)
            seen.update(zip(value.tolist(), (before + count).tolist()))
            more = [pa.array(np.full(len(lengths), task)), pa.array(local)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns] + more, names=[*columns, "_task", "_local"])

    return run


def _placed(slots: np.ndarray, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = (slots[:, 0] << 48) + slots[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            slot = slots[np.searchsorted(begin, (length << 48) + rank, side="right") - 1]
            turn, inside = np.divmod(rank - slot[:, 1], slot[:, 2])
            more = [pa.array(slot[:, 3] + turn), pa.array(slot[:, 4] + inside * length)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns] + more, names=[*columns, "sequence_id", "offset"])

    return run


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id, offset`` for each row of a frame with a ``length`` from 1 to ``capacity``; other columns stay.

    The rows are written once, numbered per task and length. Totals of (task, length) give
    each row its rank among all rows of its length, and the rank its place: equal lengths,
    repeated rows and rows that are a third of the table are spread over all tasks.
    What reaches the driver is one count per length. An empty frame stays empty.
    """
    columns = [c for c in found.columns if c not in ("sequence_id", "offset", "_task", "_local", "_rank")]
    found = found.select(*columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)
    rows = materialize(found.mapInArrow(_numbered(columns), f"{schema}, _task long, _local long"), "pieces")
    totals = rows.groupBy("_task", "length").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_task", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in totals.groupBy("length").agg(F.sum("_n")).collect():
        counts[length] = n
    _, slots = plan_sequences(counts)
    ranked = rows.join(starts, ["_task", "length"]).select(*columns, (F.col("_start") + F.col("_local")).alias("_rank"))
    return ranked.mapInArrow(_placed(slots, columns), f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` of a packed frame that still holds the pieces' ``ids``; one sequence is at most the capacity."""
    gathered = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return gathered.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))
