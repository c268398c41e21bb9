"""Language identification by a bidirectional gated recurrent network over bytes.

Gates and candidates are squashed by ``x / (1 + |x|)``, which costs a sixth of the usual
hyperbolic tangent. Two gated recurrent layers read windows of ``WINDOW`` bytes forward and backward; at
every byte both states give a probability for each language, and a document's
probabilities are the mean over all its bytes. The network is trained here, in numpy,
by backpropagation through time on a sample of labelled documents that is bounded by
``per_class``. Inputs are the bytes of the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F

from lapsekit.llm.texts import flat, pieces

WINDOW, HIDDEN = 64, 8
PER_CLASS, SAMPLE_BYTES, STEPS, BATCH, RATE = 300, 512, 360, 128, 0.02
UNKNOWN = "und"


@dataclass
class Network:
    """Languages and weights; ``inputs[d]`` holds the gates' input of each byte in direction ``d``."""

    langs: list[str]
    inputs: list[np.ndarray]  # 2 x (256, 3H): update, reset, candidate
    states: list[np.ndarray]  # 2 x (H, 3H)
    heads: list[np.ndarray]  # 2 x (H, L)
    bias: np.ndarray

    @classmethod
    def fresh(cls, langs: list[str], hidden: int = HIDDEN, seed: int = 1) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        return cls(
            langs, [draw(256, 3 * hidden) for _ in range(2)], [draw(hidden, 3 * hidden) for _ in range(2)],
            [draw(hidden, len(langs)) for _ in range(2)], np.zeros(len(langs), np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [*self.inputs, *self.states, *self.heads, self.bias]


def _squash(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def _gate(x: np.ndarray) -> np.ndarray:
    return 0.5 * _squash(x) + 0.5


def run_layer(table: np.ndarray, state: np.ndarray, steps: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
    """States after each of ``steps`` (time x windows of bytes), and what the backward pass needs."""
    hidden, n = state.shape[0], steps.shape[1]
    out, tape = np.empty((len(steps), n, hidden), dtype=np.float32), []
    h = np.zeros((n, hidden), dtype=np.float32)
    for t, symbols in enumerate(steps):
        x = table[symbols]
        gates = h @ state
        zr = _gate(x[:, : 2 * hidden] + gates[:, : 2 * hidden])
        z, r, g = zr[:, :hidden], zr[:, hidden:], gates[:, 2 * hidden :]
        c = _squash(x[:, 2 * hidden :] + r * g)
        new = c + z * (h - c)
        if keep:
            tape.append((h, z, r, g, c))
        out[t] = h = new
    return out, tape


def states_only(table: np.ndarray, state: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The states of :func:`run_layer`, computed in place."""
    hidden, n = state.shape[0], steps.shape[1]
    out = np.empty((len(steps), n, hidden), dtype=np.float32)
    x, gates, c = (np.empty((n, w), dtype=np.float32) for w in (3 * hidden, 3 * hidden, hidden))
    h = np.zeros((n, hidden), dtype=np.float32)
    zr, scale, scale_c = (np.empty((n, w), dtype=np.float32) for w in (2 * hidden, 2 * hidden, hidden))
    for t, symbols in enumerate(steps):
        np.take(table, symbols, axis=0, out=x, mode="clip")
        np.dot(h, state, out=gates)
        np.add(x[:, : 2 * hidden], gates[:, : 2 * hidden], out=zr)
        np.abs(zr, out=scale)
        scale += 1
        zr /= scale
        zr *= 0.5
        zr += 0.5
        np.multiply(zr[:, hidden:], gates[:, 2 * hidden :], out=c)
        c += x[:, 2 * hidden :]
        np.abs(c, out=scale_c)
        scale_c += 1
        c /= scale_c
        new = out[t]
        np.subtract(h, c, out=new)
        new *= zr[:, :hidden]
        new += c
        h = new
    return out


def _layer_gradients(table: np.ndarray, state: np.ndarray, steps: np.ndarray, tape: list, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of input table and state matrix, from the gradient wanted at each state: backpropagation through time."""
    hidden = state.shape[0]
    d_table, d_state = np.zeros_like(table), np.zeros_like(state)
    carried = np.zeros_like(wanted[0])
    for t in range(len(steps) - 1, -1, -1):
        h, z, r, g, c = tape[t]
        d = wanted[t] + carried
        d_c = d * (1 - z) * (1 - np.abs(c)) ** 2
        d_z = d * (h - c) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
        d_r = d_c * g * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
        d_x = np.concatenate([d_z, d_r, d_c], axis=1)
        d_g = np.concatenate([d_z, d_r, d_c * r], axis=1)
        np.add.at(d_table, steps[t], d_x)
        d_state += h.T @ d_g
        carried = d * z + d_g @ state.T
    return d_table, d_state


def position_probabilities(net: Network, windows: np.ndarray) -> np.ndarray:
    """Language probabilities at each byte of ``windows`` (windows x bytes): time x windows x languages."""
    steps = np.ascontiguousarray(windows.T)
    logits = states_only(net.inputs[0], net.states[0], steps) @ net.heads[0]
    logits += (states_only(net.inputs[1], net.states[1], steps[::-1]) @ net.heads[1])[::-1]
    logits += net.bias
    logits -= logits.max(axis=2, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=2, keepdims=True)
    return logits


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of all rows as windows padded with zeros, the row of each window and its number of real bytes."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), count)
    place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    begin = offsets[row] + place * WINDOW
    real = np.minimum(offsets[row + 1] - begin, WINDOW)
    at = begin[:, None] + np.arange(WINDOW)
    windows = np.where(np.arange(WINDOW) < real[:, None], data[np.minimum(at, max(len(data) - 1, 0))], 0) if len(row) else np.zeros((0, WINDOW))
    return windows.astype(np.uint8), row, real


def train(texts: list[bytes], labels: list[str], steps_in_all: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 1) -> Network:
    """Fit a network by Adam; texts and labels are in memory and bounded by the caller."""
    langs = sorted(set(labels))
    net = Network.fresh(langs, seed=seed)
    data, offsets = flat(pa.array(texts, pa.large_binary()))
    windows, row, real = cut(data, offsets)
    target = np.array([langs.index(x) for x in labels])[row]
    rng = np.random.default_rng(seed)
    first, second, step = [np.zeros_like(p) for p in net.parameters()], [np.zeros_like(p) for p in net.parameters()], 0
    while step < steps_in_all and len(row):
        for chosen in np.array_split(rng.permutation(len(row)), max(1, -(-len(row) // batch))):
            if step >= steps_in_all:
                break
            steps = np.ascontiguousarray(windows[chosen].T)
            tapes = [run_layer(net.inputs[d], net.states[d], steps[:: 1 - 2 * d], keep=True) for d in (0, 1)]
            states = [tapes[0][0], tapes[1][0][::-1]]
            logits = states[0] @ net.heads[0] + states[1] @ net.heads[1] + net.bias
            logits = np.exp(logits - logits.max(axis=2, keepdims=True))
            d = logits / logits.sum(axis=2, keepdims=True)
            d[:, np.arange(len(chosen)), target[chosen]] -= 1
            d *= (np.arange(WINDOW)[:, None] < real[chosen]).astype(np.float32)[:, :, None] / real[chosen].sum()
            gradients = [None] * 7
            for k in (0, 1):
                wanted = d @ net.heads[k].T
                gradients[4 + k] = np.einsum("tnh,tnl->hl", states[k], d)
                gradients[k], gradients[2 + k] = _layer_gradients(
                    net.inputs[k], net.states[k], steps[:: 1 - 2 * k], tapes[k][1], wanted[:: 1 - 2 * k]
                )
            gradients[6] = d.sum(axis=(0, 1))
            norm = float(np.sqrt(sum((g * g).sum() for g in gradients)))
            step += 1
            now = rate * min(1.0, step / 20) * (1 - 0.9 * step / steps_in_all)
            for p, g, a, b in zip(net.parameters(), gradients, first, second):
                g = g * min(1.0, 1.0 / max(norm, 1e-9))
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= now * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return net


def fit(docs: DataFrame, per_class: int = PER_CLASS) -> Network | None:
    """Train on about ``per_class`` documents of each language, drawn by a hash of the text.

    Only documents with a lang whose crc32 of the id modulo 4 is not 2 take part, each
    with ``SAMPLE_BYTES`` characters from a hashed place. ``None`` without labelled texts.
    """
    known = docs.where("lang is not null and text is not null and doc_id is not null and text rlike '\\\\p{L}'")
    known = known.where("crc32(cast(cast(doc_id as long) as string)) % 4 <> 2")
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return None
    draw = F.pmod(F.xxhash64("text", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    keep = F.lit(False)
    for lang, n in sizes.items():
        keep = keep | ((F.col("lang") == lang) & (draw < per_class / n))
    room = F.greatest(F.lit(1), F.length("text") - SAMPLE_BYTES)
    begin = 1 + F.pmod(F.xxhash64("text", F.lit(4)), room).cast("int")
    rows = known.where(keep).select("lang", F.substring("text", begin, F.lit(SAMPLE_BYTES)).alias("text")).dropDuplicates()
    rows = rows.orderBy(F.xxhash64("text"), "lang").limit(4 * per_class * len(sizes)).collect()
    if not rows:  # so few rows that the draw left none
        rows = known.select("lang", F.substring("text", 1, SAMPLE_BYTES).alias("text")).limit(per_class).collect()
    return train([r["text"].encode() for r in rows], [r["lang"] for r in rows])


def _document_probabilities(net: Network, column: pa.Array) -> np.ndarray:
    """Mean of the probabilities over all bytes of each row; windows are labelled ``SLICE`` at a time."""
    data, offsets = flat(column)
    windows, row, real = cut(data, offsets)
    total = np.zeros((len(column), len(net.langs)))
    for a in range(0, len(row), SLICE):
        part = slice(a, a + SLICE)
        held = (np.arange(WINDOW)[:, None] < real[part]).astype(np.float32)
        np.add.at(total, row[part], np.einsum("tnl,tn->nl", position_probabilities(net, windows[part]), held))
    return total / np.maximum(np.diff(offsets), 1)[:, None]


SLICE = 2048


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for each row of ``docs(doc_id, text)``.

    A null text, a text without a letter or a missing network gives ``und`` with score
    0. A null ``doc_id`` is kept and not held out; repeated rows are predicted each;
    other columns are ignored.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    if net is None:
        return base.select("doc_id", held.alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                chance = _document_probabilities(net, part.column("text"))
                best = chance.argmax(axis=1)
                ok = pa.compute.and_(part.column("text").is_valid(), part.column("lettered").fill_null(False))
                lang = pa.compute.if_else(ok, pa.array([net.langs[i] for i in best], pa.string()), UNKNOWN)
                score = pa.compute.if_else(ok, pa.array(np.clip(chance.max(axis=1), 0, 1), pa.float64()), 0.0)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lang, score], names=["doc_id", "lang_pred", "score"])

    marked = base.withColumn("lettered", F.col("text").rlike("\\p{L}"))
    out = marked.mapInArrow(run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
