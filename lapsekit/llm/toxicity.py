"""Toxicity scores from a weighted lexicon matched by Aho-Corasick.

Texts are folded first: lower case, look-alike letters of other scripts and
full-width forms to Latin, digits and signs that stand for letters inside words,
everything that is not a letter or digit to one space. The lexicon holds word
stems (``' idiot'``) and whole words (``' scum '``) with weights; hits inside an
exception phrase do not count. The weighted hits, plain and per word, go through
a logistic curve.

Lexicon weights and curve are learned from a sample of labelled rows that is
bounded by ``per_class``: one half of it chooses entries, the other half fits the
curve. Without labels the fixed entries and a fixed curve are used.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lapsekit.llm.texts import pieces

PER_CLASS, LEXICON_MOST = 2000, 4000
SHORTEST, LONGEST = 3, 14

# General insults with a prior weight, and harmless phrases around such words.
SEED_WORDS = [
    "bastard", "clown", "cretin", "degenerate", "despicable", "disgusting", "dumb", "dumbass", "fool", "filth", "freak", "garbage",
    "idiot", "idiotic", "imbecile", "jerk", "loser", "lowlife", "maggot", "moron", "moronic", "pathetic", "pig", "rubbish",
    "scum", "scumbag", "stupid", "trash", "twit", "ugly", "vermin", "worthless",
]
SEED_WEIGHT = 2.0
EXCEPTIONS = [
    "clown fish", "class clown", "trash can", "trash bin", "trash bag", "garbage can", "garbage collection", "garbage truck",
    "guinea pig", "pig iron", "pond scum", "idiot proof", "soap scum", "fool proof", "april fool", "rubbish bin", "ugly duckling",
]
LOOKALIKES = dict(zip("аеорсухіјѕԁһкмтвнαοερντκυιі", "aeopcyxijsdhkmtbhaoepvtkuii", strict=True))
DIGITS = str.maketrans("0134578@$", "oieastbas")


def _fold_table() -> dict[int, str | None]:
    table: dict[int, str | None] = {ord(k): v for k, v in LOOKALIKES.items()}
    table |= {0xFF01 + i: chr(0x21 + i).lower() for i in range(94)}
    table |= {c: None for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}
    table |= {c: " " for c in range(0x80) if not chr(c).isalnum() and chr(c) not in "@$"}
    table |= {c: " " for c in [*range(0xA0, 0xC0), *range(0x2010, 0x2050), *range(0x3000, 0x3004)] if c not in (0xAA, 0xB5, 0xBA, 0xAD)}
    return table


_TABLE = _fold_table()
_DISGUISED = re.compile(r"[0-9]+(?=[a-z])|(?<=[a-z])[@$]+(?=[a-z])")


def fold(text: str | None) -> list[str]:
    """The folded words of a text; none for a null."""
    if not text:
        return []
    plain = text.lower().translate(_TABLE)
    plain = _DISGUISED.sub(lambda m: m.group().translate(DIGITS), plain)
    if "@" in plain or "$" in plain:
        plain = plain.replace("@", " ").replace("$", " ")
    return plain.split()


@dataclass
class Model:
    """Lexicon entries with weights, phrases that excuse hits, and the curve."""

    entries: dict[str, float]
    exceptions: list[str] = field(default_factory=lambda: list(EXCEPTIONS))
    curve: tuple[float, float, float] = (-4.0, 2.0, 0.5)

    def automaton(self) -> ahocorasick.Automaton:
        auto = ahocorasick.Automaton()
        for phrase in self.exceptions:
            auto.add_word(f" {phrase} ", (len(phrase), 0.0))
        for entry, weight in self.entries.items():
            auto.add_word(entry, (len(entry) - 1, weight))
        auto.make_automaton()
        return auto

    def score(self, weight: np.ndarray, words: np.ndarray) -> np.ndarray:
        a, b, c = self.curve
        return 1 / (1 + np.exp(-np.clip(a + b * np.log1p(weight) + c * np.log1p(1000 * weight / np.maximum(words, 1)), -30, 30)))


def weigh(auto: ahocorasick.Automaton, words: list[str]) -> float:
    """Summed weight of the longest entry at each word start outside exception phrases."""
    if not words:
        return 0.0
    best: dict[int, float] = {}
    excused: list[tuple[int, int]] = []
    for end, (length, weight) in auto.iter(f" {' '.join(words)} "):
        if weight == 0.0:
            excused.append((end - length - 1, end))
        else:
            start = end - length
            best[start] = max(weight, best.get(start, 0.0))
    return sum(w for at, w in best.items() if not any(a <= at < b for a, b in excused))


def _measured(auto: ahocorasick.Automaton, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Weight and number of words of each text; the words of one text at a time are in memory."""
    weight, count, i = np.zeros(batch.num_rows), np.zeros(batch.num_rows, dtype=np.int64), 0
    for part in pieces(batch, "text"):
        for text in part.column("text").to_pylist():
            words = fold(text)
            weight[i], count[i] = weigh(auto, words), len(words)
            i += 1
    return weight, count


def _weights(entries: Model, carry: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = entries.automaton()
        for batch in batches:
            weight, count = _measured(auto, batch)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carry), pa.array(weight), pa.array(count)], names=[*carry, "weight", "words"]
            )

    return run


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each stem and whole word of a text once, with its label."""
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = set(fold(text))
            terms = {f" {w[:n]}" for w in words for n in range(SHORTEST, min(len(w), LONGEST) + 1)}
            terms |= {f" {w} " for w in words if len(w) >= SHORTEST}
            out = list(terms)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array([toxic] * len(out), pa.int32())], names=["term", "toxic"])


def choose(counts: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Entries with weights: of nested stems the shortest that is telling, then lengthened while no support is lost."""
    known = {t: (a, b) for t, a, b in counts}
    children: dict[str, list[str]] = {}
    for t in known:
        children.setdefault(t[:-1], []).append(t)
    out: dict[str, float] = {}
    for t in sorted(known, key=lambda t: (len(t), t)):
        if any(t[:n] in known for n in range(SHORTEST + 1, len(t))):
            continue
        here = t
        while True:
            longer = [c for c in children.get(here, []) if known[c][0] >= 0.9 * known[t][0]]
            if not longer:
                break
            here = max(longer, key=lambda c: known[c][0])
        a, b = known[here]
        out[here] = math.log(((a + 0.5) / (n_toxic + 1)) / ((b + 0.5) / (n_clean + 1)))
    return out


def fit_curve(weight: np.ndarray, words: np.ndarray, label: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression on the two logarithms, by Newton steps with a small ridge."""
    x = np.stack([np.ones(len(label)), np.log1p(weight), np.log1p(1000 * weight / np.maximum(words, 1))], axis=1)
    beta, ridge = np.zeros(3), np.diag([1e-3, 0.05, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (label - p) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Learn from at most ``2 * per_class`` labelled rows of each class, drawn by a hash of ``doc_id``.

    Only rows whose crc32 of the id is not divisible by 5 take part; null labels and
    labels other than 0 and 1 are ignored.
    """
    model = Model({f" {w} ": SEED_WEIGHT for w in SEED_WORDS})
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    ids = ids.where("toxic in (0, 1) and doc_id is not null and crc32(cast(doc_id as string)) % 5 <> 0")
    sizes = {r["toxic"]: r["count"] for r in ids.groupBy("toxic").count().collect()}
    if min(sizes.get(0, 0), sizes.get(1, 0)) == 0:
        return model
    draw = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    keep = F.lit(False)
    for label, n in sizes.items():
        keep = keep | ((F.col("toxic") == label) & (draw < per_class / n))
    # A sample of bounded size may be broadcast; the texts then are not shuffled.
    sample = F.broadcast(ids.where(keep).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2))).limit(4 * per_class))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id")

    half = {r["toxic"]: r["count"] for r in sample.where("part = 0").groupBy("toxic").count().collect()}
    n1, n0 = half.get(1, 0), half.get(0, 0)
    terms = texts.where("part = 0").select("text", "toxic").mapInArrow(_terms, "term string, toxic int")
    counts = terms.groupBy("term").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    telling = counts.where((F.col("a") >= max(5, n1 / 50)) & (F.col("b") * max(n1, 1) <= 0.04 * F.col("a") * max(n0, 1)))
    best = telling.orderBy(F.desc("a"), "term").limit(LEXICON_MOST).collect()
    model.entries |= choose([(r["term"], r["a"], r["b"]) for r in best], n1, n0)

    rows = texts.where("part = 1").select("text", "toxic").mapInArrow(_weights(model, ["toxic"]), "toxic int, weight double, words long").collect()
    if len({r["toxic"] for r in rows}) == 2:
        weight, words, label = (np.array([float(r[c]) for r in rows]) for c in ("weight", "words", "toxic"))
        model.curve = fit_curve(weight, words, label)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs(doc_id, text)``.

    Null and empty texts have no hits and get the curve's lowest score; a null
    ``doc_id`` is kept and not held out; repeated rows are scored each; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in _weights(model, ["doc_id"])(batches):
            value = model.score(out.column("weight").to_numpy(), out.column("words").to_numpy())
            yield pa.RecordBatch.from_arrays([out.column("doc_id"), pa.array(value)], names=["doc_id", "score"])

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    scored = base.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text scores under 0.5, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = model.automaton()
        for batch in batches:
            yield batch.filter(pa.array(model.score(*_measured(auto, batch)) < 0.5))

    return docs.mapInArrow(run, docs.schema)
