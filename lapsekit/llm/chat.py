"""Chat formatting with a loss mask aligned by offsets.

Each turn is rendered as ``### ``, the role, ``</role>``, a line break, the text,
``</turn>`` and a line break. Inside roles and texts a backslash sets apart two ``#``
in a row, the slash of ``</role>`` and ``</turn>``, the bar of ``<|`` (which begins the
tokenizer's own control tokens) and every backslash, so no mark can occur there, and
the escape is undone exactly.

The rendered conversation is encoded once. The tokenizer reports the characters each
token covers; the spans of the assistants' texts are sorted too, so two binary searches
per token tell whether it lies in one. The marks are tokens of their own: no token
covers both a mark and text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

DEFAULT_TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
HEAD, BREAK, TAIL = "### ", "</role>\n", "</turn>\n"
ASSISTANT = "assistant"
BLOCK_CHARS = 1 << 20


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\").replace("</turn>", "<\\/turn>").replace("</role>", "<\\/role>").replace("<|", "<\\|")
    return re.sub(r"#(?=#)", r"#\\", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """The rendered turns and the sorted character spans of the assistants' texts."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{HEAD}{escape(role)}{BREAK}", escape(text)
        out += [head, body, TAIL]
        if role == ASSISTANT and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(TAIL)
    return "".join(out), np.array(spans, dtype=np.int64).reshape(-1, 2)


def parse(rendered: str) -> list[tuple[str, str]]:
    """Roles and texts of a rendered conversation."""
    turns = []
    for part in rendered.split(TAIL)[:-1]:
        role, _, body = part.removeprefix(HEAD).partition(BREAK)
        turns.append((unescape(role), unescape(body)))
    return turns


def align(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """For each token (start, end): does it lie in one of the sorted spans."""
    if not len(spans) or not len(offsets):
        return np.zeros(len(offsets), dtype=bool)
    at = np.searchsorted(spans[:, 0], offsets[:, 0], side="right") - 1
    until = np.searchsorted(spans[:, 1], offsets[:, 1], side="left")
    return (at >= 0) & (until == at) & (offsets[:, 1] > offsets[:, 0])


def load_tokenizer(definition: str):
    """The tokenizer with the marks as tokens of their own."""
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.add_special_tokens([AddedToken(mark, normalized=False) for mark in (HEAD, BREAK, TAIL)])
    return tokenizer


def tokens_of(tokenizer, rendered: str, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, character offsets and loss mask of a rendered conversation."""
    encoded = tokenizer.encode(rendered, add_special_tokens=False)
    offsets = np.array(encoded.offsets, dtype=np.int64).reshape(-1, 2)
    return np.array(encoded.ids, dtype=np.int32), offsets, align(offsets, spans)


def masked_text(rendered: str, offsets: np.ndarray, mask: np.ndarray) -> list[str]:
    """The characters under the mask, unescaped, as one string for each maximal run of tokens."""
    out = []
    if mask.any():
        edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
        for a, b in zip(edges[::2], edges[1::2]):
            out.append(unescape(rendered[offsets[a, 0] : offsets[b - 1, 1]]))
    return out


SCHEMA = "conv_id long, part int, n_turns long, formatted string, ids array<int>, loss_mask array<boolean>, offsets array<int>"


def formatted(conversations: DataFrame, tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """One row per conversation: rendered text, token ids, loss mask and the tokens' offsets.

    Turns are taken in the order of ``turn``, equal turns by role and text; null turns
    come first, a null role or text is empty, repeated rows are turns of their own, rows
    with a null ``conv_id`` form one conversation. Rows are sorted, not gathered: a
    conversation is closed when the next one begins. One longer than ``BLOCK_CHARS`` characters
    goes on in a further row (``part`` 1, 2, ...), always at the start of a turn, where
    encoding is the same as in one piece. Other columns are ignored.
    """
    definition = Path(tokenizer).read_text()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_tokenizer(definition)
        turns: list[tuple[str, str]] = []
        done: list[tuple] = []
        key, part, size, started = None, 0, 0, False

        def close() -> None:
            rendered, spans = render(turns)
            ids, offsets, mask = tokens_of(model, rendered, spans)
            done.append((key, part, len(turns), rendered, ids, mask, offsets.reshape(-1)))
            turns.clear()

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.list_(pa.int32())]
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv_id", "part", "n_turns", "formatted", "ids", "loss_mask", "offsets"]
            )

        for batch in batches:
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                role, text = role or "", text or ""
                if started and conv != key:
                    close()
                    part = size = 0
                elif started and size >= BLOCK_CHARS:
                    close()
                    part, size = part + 1, 0
                key, started = conv, True
                turns.append((role, text))
                size += len(role) + len(text)
                if len(done) >= 500 or (done and size >= BLOCK_CHARS):
                    yield flush()
        if turns:
            close()
        if done:
            yield flush()

    base = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    dealt = base.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(run, SCHEMA)


def digests(output: DataFrame) -> DataFrame:
    """What is read back from :func:`formatted`: turns, text under the mask, and their digests, per conversation.

    The parts of a long conversation must follow each other, as they do there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, state = [], None
        for batch in batches:
            spans, span_at = batch.column("offsets").flatten().to_numpy(), batch.column("offsets").offsets.to_numpy()
            masks, mask_at = batch.column("loss_mask").flatten().to_numpy(zero_copy_only=False), batch.column("loss_mask").offsets.to_numpy()
            span_at, mask_at = span_at - span_at[0], mask_at - mask_at[0]
            rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "part", "formatted")))
            for i, (conv, part, rendered) in enumerate(rows):
                if state is None or part == 0:
                    if state:
                        done.append(state)
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(rendered):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                offsets = spans[span_at[i] : span_at[i + 1]].reshape(-1, 2)
                for text in masked_text(rendered, offsets, masks[mask_at[i] : mask_at[i + 1]]):
                    state[3] += len(text)
                    state[4].update(text.encode())
                state[5] += len(rendered)
            if len(done) > 1000:
                yield _digest_rows(done)
                done.clear()
        if state:
            done.append(state)
        yield _digest_rows(done)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    columns = output.select("conv_id", "part", "formatted", "loss_mask", "offsets")
    return columns.mapInArrow(run, schema)


def _digest_rows(done: list[list]) -> pa.RecordBatch:
    rows = [(c, n, a.hexdigest(), k, b.hexdigest(), size) for c, n, a, k, b, size in done]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    columns = list(zip(*rows)) or [()] * 6
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
