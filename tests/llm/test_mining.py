"""Packing, hard negatives and collocations against plain Python."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from lapsekit.llm import collocations, negatives, packing
from tests.llm.helpers import awkward, clashing, docs, prose, rows

# ---- packing


@pytest.fixture(scope="module")
def word_tokenizer():
    return Tokenizer.from_file(packing.DEFAULT_TOKENIZER)


TEXTS = [
    "", " ", "ΑΣ ΣΑΣ", "a'sb 'S it's !'s '' s", "é é ́a x y z q", "<|endoftext|> a <|x|> <|startoftext|>b",
    "\x1c\x1d a\x1fb \x85 c\u0085d", "İI ǅ ß ﬁ", "Word, word; WORD. word! w0rd? 123.", "日本 🎉x", "x" * 3000, "Café, ÀÉÎÕÜ; straße Øl. naïve× ÷a ªº µm Ÿes ÿ!",
]


def test_word_by_word_is_the_tokenizer(word_tokenizer):
    model = packing.WordTokenizer(word_tokenizer.to_str())
    rng = random.Random(4)
    random_texts = ["".join(rng.choice("ab' ,.!Éß́\nZ7<|>÷") for _ in range(60)) for _ in range(200)]
    for text in TEXTS + random_texts:
        assert np.frombuffer(model.ids(text.encode()), np.uint32).tolist() == word_tokenizer.encode(text, add_special_tokens=False).ids, text


def test_long_texts_are_encoded_in_slices(word_tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 50)
    monkeypatch.setattr(packing, "KNOWN_WORDS", 30)
    text = prose(random.Random(1), 800) + " " + "y" * 200 + "\tend"
    model = packing.WordTokenizer(word_tokenizer.to_str())
    assert np.frombuffer(model.ids(text.encode()), np.uint32).tolist() == word_tokenizer.encode(text, add_special_tokens=False).ids


def best_fit_decreasing(counts):
    capacity, room = len(counts) - 1, []
    for length in range(capacity, 0, -1):
        for _ in range(counts[length]):
            fitting = [i for i, r in enumerate(room) if r >= length]
            if fitting:
                at = min(fitting, key=lambda i: room[i])
                room[at] -= length
            else:
                room.append(capacity - length)
    return len(room)


def check_slots(counts, number, slots):
    used, placed = defaultdict(list), Counter()
    for j, (length, first, copies, sequence, offset) in enumerate(slots):
        same = j + 1 < len(slots) and slots[j + 1][0] == length
        end = slots[j + 1][1] if same else counts[length]
        placed[length] += end - first
        for rank in range(first, end):
            turn, inside = divmod(rank - first, copies)
            used[sequence + turn].append((offset + inside * length, length))
    assert all(placed[i] == c for i, c in enumerate(counts)) and len(used) == number
    for held in used.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= len(counts) - 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=300), st.integers(0, 400), st.integers(1, 60))
def test_plans_place_every_piece_once(lengths, hot, length):
    counts = np.bincount(lengths + [length] * hot, minlength=61)
    number, slots = packing.plan_sequences(counts)
    check_slots(counts, number, slots)
    assert number <= best_fit_decreasing(counts)


def test_configurations_beat_greedy_packing():
    rng = np.random.default_rng(1)
    for low, high in ((500, 1200), (683, 2048), (1, 2048)):
        counts = np.bincount(rng.integers(low, high, 3000), minlength=2049)
        number, slots = packing.plan_sequences(counts)
        check_slots(counts, number, slots)
        assert number <= best_fit_decreasing(counts)
    thirds = np.bincount(np.clip(rng.normal(680, 60, 3000), 1, 2048).astype(int), minlength=2049)
    assert packing.plan_sequences(thirds)[0] < 0.98 * best_fit_decreasing(thirds)


def check_packed(found, pairs, tokenizer, capacity):
    want = []
    for doc, text in pairs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for i, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], dtype="<u4")
            want.append((doc, i, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found], key=repr) == sorted(want, key=repr)
    places = defaultdict(list)
    for r in found:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(places) >= math.ceil(sum(r["length"] for r in found) / capacity)
    return len(places)


def test_packed_documents(spark, word_tokenizer):
    rng = random.Random(2)
    pairs = awkward() + [(i + 100, t) for i, t in enumerate(TEXTS)] + [(i + 200, prose(rng, rng.randrange(1, 300))) for i in range(150)]
    pairs += [(7, "same words here")] * 60
    packed = packing.pack(packing.pieces(clashing(docs(spark, pairs)), capacity=512), 512)
    found = packed.collect()
    check_packed(found, pairs, word_tokenizer, 512)
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    for r in found:
        assert whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]
    assert packing.pack(packing.pieces(docs(spark, []))).collect() == []


# ---- hard negatives


def brute_negatives(vectors, positives=5, negatives_=3, low=50, high=95, every=50, scale=256):
    usable = set()
    for vec_id, label, v in vectors:
        if vec_id is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            most = float(negatives.LARGEST)
            usable.add((vec_id, label, tuple(int(max(-most, min(most, math.floor(scale * max(-most, min(most, x)))))) for x in v)))
    out = []
    for a in usable:
        if a[0] % every:
            continue
        scored = [(sum(x * y for x, y in zip(a[2], b[2])), b) for b in usable if b != a and len(b[2]) == len(a[2])]
        same = sorted((-s, b[0]) for s, b in scored if b[1] == a[1])[:positives]
        for s, positive in same:
            fitting = sorted((-n, b[0]) for n, b in scored if b[1] != a[1] and low * -s <= 100 * n <= high * -s)
            for rank, (n, negative) in enumerate(fitting[:negatives_], 1):
                out.append((a[0], positive, rank, negative, -s, -n))
    return sorted(out, key=repr)


def vector_rows(rng, n, dims=8, spread=0.3, labels=3):
    centres = rng.normal(size=(5, dims))
    lengths = rng.choice([0.2, 1.0, 3.0], n)
    made = (centres[rng.integers(0, 5, n)] + spread * rng.normal(size=(n, dims))) * lengths[:, None]
    return [(i, int(rng.integers(0, labels)), [float(np.float32(x)) for x in v]) for i, v in enumerate(made)]


VECTORS = "vec_id long, label int, embedding array<float>"


@pytest.mark.parametrize("seed", [1, 2])
def test_negatives_match_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(negatives, "LEAST_ROWS", 40)
    rng = np.random.default_rng(seed)
    made = vector_rows(rng, 260)
    made += [(1000 + i, i % 2, made[3][2]) for i in range(80)]  # a large group of equal vectors
    got = negatives.mine(spark.createDataFrame(made, VECTORS), every=10)
    assert rows(got) == brute_negatives(made, every=10)


def test_negatives_take_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "LEAST_ROWS", 16)
    rng = np.random.default_rng(5)
    made = vector_rows(rng, 60, dims=3)
    made += [(None, 1, [1.0, 0.0, 0.0]), (70, None, [1.0, 0.0, 0.0]), (71, 1, None), (72, 1, [1.0, None, 0.0]), (73, 1, [math.nan, 0.0, 0.0])]
    made += [(74, 0, [math.inf, 0.0, 0.0]), (80, 0, [0.0, 0.0, 0.0]), (90, 1, [1.0, 2.0]), (91, 1, [2.0, 2.0]), (92, 0, [1.0, 1.5])]
    made += [(100, 2, []), (101, 2, []), (102, 0, []), (110, 1, [1e30, -1e30, 1.0]), (-10, 1, [-1.0, 0.5, 0.25]), made[4], made[4], made[10]]
    got = negatives.mine(clashing(spark.createDataFrame(made, VECTORS)), every=10)
    assert rows(got) == brute_negatives(made, every=10)
    assert negatives.mine(spark.createDataFrame([], VECTORS)).collect() == []


def test_pruning_is_safe_and_prunes(monkeypatch):
    monkeypatch.setattr(negatives, "BUCKET", 32)
    rng = np.random.default_rng(3)
    vectors = np.floor(256 * np.array([v for _, _, v in vector_rows(rng, 600, spread=0.05)])).astype(np.int32)
    index, seen = negatives.Index(vectors), 0
    for anchor in vectors[:20]:
        scores = vectors.astype(np.int64) @ anchor.astype(np.int64)
        for share in (0.95, 0.5):
            least = int(scores.max() * share)
            found = {}
            for at, score in index.search(anchor, lambda: least):
                found |= dict(zip(at.tolist(), score.tolist()))
            assert all(found[i] == scores[i] for i in found)
            assert set(np.flatnonzero(scores >= least).tolist()) <= set(found)
            seen += len(found)
    assert seen < 20 * 2 * 600 / 3
    large = np.full((3, 4), negatives.LARGEST, dtype=np.int32)
    assert negatives.Index(large).scores(large[0], np.arange(3)).tolist() == [4 * negatives.LARGEST**2] * 3


# ---- collocations


def brute_collocations(pairs, least, best=2000, absorbed=100):
    """``pairs`` of (lang, text)."""
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in pairs:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, found in counts.items():
        n, kept = totals[lang], []
        candidates = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        around = Counter()
        for q, b in candidates.items():
            for size in range(2, len(q)):
                for i in range(len(q) - size + 1):
                    around[q[i : i + size]] = max(around[q[i : i + size]], b)
        for p, a in candidates.items():
            score, k = min((1000 * a * n // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p)))
            if 100 * around[p] < absorbed * a:
                kept.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out, key=repr)


def spoken(spark, pairs):
    return spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(pairs)], "doc_id long, text string, lang string")


@pytest.mark.parametrize("seed, absorbed", [(1, 100), (2, 60)])
def test_collocations_match_brute_force(spark, seed, absorbed):
    rng = random.Random(seed)
    fixed = ["New York", "in the middle of nowhere", "Éa b c d e f", "x x x x x x x"]
    pairs = []
    for _ in range(250):
        text = "".join(rng.choice([*"ab cd ef gh".split(), *fixed]) + rng.choice([" ", " ", "  ", ", ", ".\n", "\t", " ", ";"]) for _ in range(rng.randrange(0, 25)))
        pairs.append((rng.choice(["en", "de", None, "und"]), text))
    pairs += [("en", "one and the same line of words")] * 60
    got = collocations.collocations(spoken(spark, pairs), least=12, best=30, absorbed=absorbed)
    assert rows(got) == brute_collocations(pairs, 12, 30, absorbed)


def test_collocations_take_awkward_rows(spark, monkeypatch):
    pairs = [("en", t) for _, t in awkward()] * 2 + [("", "a b"), (None, None), ("xx", None), ("en", "z " * 30_000), ("en", "." * 1000)]
    got = collocations.collocations(clashing(spoken(spark, pairs)), least=2)
    assert rows(got) == brute_collocations(pairs, 2)
    assert collocations.collocations(spoken(spark, [])).collect() == []
    assert collocations.collocations(spoken(spark, [(None, None), ("en", " .")])).collect() == []


def test_scores_beyond_64_bits_are_exact(spark):
    from pyspark.sql import functions as F

    a, n, l, r = 987_654_321_987, 9_876_543_210_987, 999_999_999_999, 987_654_321_988
    frame = spark.createDataFrame([(a, n, l, r)], "a long, n long, l long, r long")
    assert frame.select(F.expr(collocations.SCORE)).first()[0] == 1000 * a * n // (l * r)
