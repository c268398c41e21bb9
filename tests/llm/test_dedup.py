"""Near-duplicates, repeated strings, vectors and contamination against plain Python."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from lapsekit.llm import decontamination, minhash, suffixes, vectors
from lapsekit.llm.components import components
from tests.llm.helpers import awkward, clashing, docs, prose, rows


def classes(nodes, links):
    best = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(best[a], best[b])
            if best[a] != low or best[b] != low:
                best[a] = best[b] = low
                changed = True
    return best


def shingles(text, k):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", low) if w]
    if not words:
        return set()
    return {tuple(words)} if len(words) < k else {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute_near(pairs, k, threshold=80):
    sets = [(i, shingles(t, k)) for i, t in pairs]
    links = [
        (a, b) for (a, x), (b, y) in itertools.combinations([s for s in sets if s[0] is not None and s[1]], 2)
        if 100 * len(x & y) >= threshold * len(x | y)
    ]
    best = classes({i for i, _ in sets if i is not None}, links)
    return sorted(((i, len(s), best.get(i), i is not None and best[i] == i) for i, s in sets), key=repr)


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = prose(rng, 1)
    return " ".join(words)


def near_group(rng):
    base = prose(rng, 150)
    return [base, *(edited(rng, base, rng.randrange(0, 14)) for _ in range(60)), *(prose(rng, 100) for _ in range(20))]


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_match_brute_force(spark, k):
    pairs = list(enumerate(near_group(random.Random(k))))
    assert rows(minhash.near_duplicates(docs(spark, pairs), k)) == brute_near(pairs, k)


def test_near_duplicates_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL", 2)
    monkeypatch.setattr(minhash, "BLOCK_ITEMS", 1000)
    pairs = list(enumerate(near_group(random.Random(3))))
    assert rows(minhash.near_duplicates(docs(spark, pairs), 2)) == brute_near(pairs, 2)


def test_near_duplicates_take_awkward_rows(spark):
    assert rows(minhash.near_duplicates(clashing(docs(spark, awkward())), 2)) == brute_near(awkward(), 2)
    assert minhash.near_duplicates(docs(spark, [])).collect() == []


def test_ids_on_several_texts_are_one_document(spark):
    rng = random.Random(8)
    a, b, c = prose(rng, 50), prose(rng, 50), prose(rng, 50)
    pairs = [(1, a), (2, a), (2, b), (3, b + " end"), (4, c), (4, c), (5, c), (6, "own"), (6, None)]
    got = rows(minhash.near_duplicates(docs(spark, pairs), 2))
    component = {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6}
    assert got == sorted(((i, len(shingles(t, 2)), component[i], i == component[i]) for i, t in pairs), key=repr)


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(1)
    for n in (1, 3, 400):
        values = rng.integers(0, 1 << 52, n, dtype=np.uint64)
        assert (minhash.sketch(np.zeros(n, np.int64), values, 1) != minhash._EMPTY).all()
    common = rng.integers(0, 1 << 52, 800, dtype=np.uint64)
    a, b = (np.concatenate([common, rng.integers(0, 1 << 52, 100, dtype=np.uint64)]) for _ in range(2))
    x, y = (minhash.sketch(np.zeros(900, np.int64), v, 1) for v in (a, b))
    assert abs((x == y).mean() - 0.8) < 0.12


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(10, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    got = dict(rows(components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {**{i: 10 for i in range(10, 41)}, **{i: 100 for i in range(100, 130)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_repeats(pairs, length):
    raw = [(i, (t or "").encode()) for i, t in pairs]
    seen = {}
    for _, b in raw:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for at in range(len(b) - length + 1):
            if seen[b[at : at + length]] > 1:
                gone[at : at + length] = b"\1" * length
        spans = sum(1 for at, g in enumerate(gone) if g and not (at and gone[at - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def repeated_corpus():
    rng = random.Random(9)
    passage = prose(rng, 60)
    texts = [f"{prose(rng, 30)} {passage} {prose(rng, 30)}" for _ in range(25)]
    texts += [passage[:199], passage[:200], passage + passage, "ab" * 300, "日本語" * 90, f"{prose(rng, 5)} {passage[100:320]}"]
    return list(enumerate(texts))


@pytest.mark.parametrize("shard", [1 << 21, 4000])
def test_repeats_match_brute_force(spark, shard):
    pairs = repeated_corpus()
    assert rows(suffixes.without_repeats(docs(spark, pairs), shard=shard)) == brute_repeats(pairs, 200)


def test_repeats_take_awkward_rows(spark):
    pairs = [(i, t if t is None or len(t) < 50_000 else t[:3000]) for i, t in awkward()]
    pairs += [(20, "a" * 3000), (21, "a" * 250 + "b"), (22, "-=" * 900), (23, ("a line of forty-two characters, repeated.\n") * 40)]
    pairs += [(24, prose(random.Random(6), 20)[:170] * 9), (25, prose(random.Random(7), 60)[:500] * 5), (26, "a" * 199), (27, "c" * 201)]
    assert rows(suffixes.without_repeats(clashing(docs(spark, pairs)))) == brute_repeats(pairs, 200)
    assert suffixes.without_repeats(docs(spark, [])).collect() == []


def test_long_and_periodic_texts_keep_their_size():
    for period in ("a", "-=", "a line of forty-two characters, repeated.\n", prose(random.Random(1), 20)[:170], prose(random.Random(2), 9000)):
        data = np.frombuffer((period * (200_000 // len(period) + 1)).encode(), np.uint8)
        _, _, first, count, several = suffixes.anchors(data, np.array([0, len(data)]))
        assert (count + 199).sum() <= 6 * len(data)
        assert count.sum() == len(data) - 199 and first[0] == 0
        assert several.any() == (len(period) < 161)


def test_texts_longer_than_a_segment(spark):
    passage = prose(random.Random(3), 60)
    far = f"{prose(random.Random(4), 200_000)}#{passage}%{prose(random.Random(5), 5000)}${passage}&"
    assert len(far) > suffixes.SEGMENT + 10_000
    got = {r["doc_id"]: r for r in suffixes.without_repeats(docs(spark, [(1, "a" * (suffixes.SEGMENT + 50_000)), (2, far)])).collect()}
    assert (got[1]["n_removed"], got[1]["n_spans"]) == (suffixes.SEGMENT + 50_000, 1)
    kept = far.replace(passage, "").encode()
    assert (got[2]["n_removed"], got[2]["n_spans"], got[2]["kept_sha256"]) == (2 * len(passage), 2, hashlib.sha256(kept).hexdigest())


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(2)
    for alphabet in (1, 2, 4):
        data = rng.integers(97, 97 + alphabet, 500).astype(np.uint8)
        sa, words = suffixes.refine(data)
        raw = data.tobytes()
        assert sa.tolist() == sorted(range(500), key=lambda i: raw[i:])
        lcp = suffixes.kasai(words, sa, 50)
        for r in range(1, 500):
            a, b = raw[sa[r - 1] :], raw[sa[r] :]
            true = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert min(lcp[r], 50) == min(true, 50)


def brute_vectors(pairs, threshold=0.9):
    ok = {}
    for n, (i, v) in enumerate(pairs):
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, dtype=np.float64)
            ok[n] = x / np.linalg.norm(x)
    links = [(a, b) for a, b in itertools.combinations(ok, 2) if len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= threshold]
    degree = {n: 0 for n in range(len(pairs))}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    best = classes({i for i, _ in pairs if i is not None}, [(pairs[a][0], pairs[b][0]) for a, b in links])
    return sorted(((i, degree[n], best.get(i), i is not None and best[i] == i) for n, (i, _) in enumerate(pairs)), key=repr)


def test_ids_on_several_vectors(spark):
    pairs = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.0, 2.0]), (3, [-1.0, 0.0]), (4, [-1.0, 0.0]), (4, [-1.0, 0.0])]
    found = vectors.near_vectors(spark.createDataFrame([(i, v, 0) for i, v in pairs], VECTOR_SCHEMA))
    assert rows(found) == brute_vectors(pairs)


VECTOR_SCHEMA = "vec_id long, embedding array<float>, label int"


def test_vectors_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "MOST", 120)
    monkeypatch.setattr(vectors, "BLOCK", 64)
    rng = np.random.default_rng(4)
    clump = rng.standard_normal(16)
    x = np.concatenate([rng.standard_normal((300, 16)), clump + 0.18 * rng.standard_normal((250, 16)), np.tile(clump, (20, 1))])
    pairs = [(int(i), [float(np.float32(a)) for a in v]) for i, v in enumerate(x)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in pairs], VECTOR_SCHEMA)
    assert rows(vectors.near_vectors(frame)) == brute_vectors(pairs)


def test_vectors_take_awkward_rows(spark):
    one = [1.0, 2.0, 3.0]
    pairs = [
        (1, one), (2, one), (3, [2.0, 4.0, 6.0]), (4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [float("nan"), 1.0, 1.0]), (8, [None, 1.0, 1.0]),
        (9, [float("inf"), 1.0, 1.0]), (10, [1.0, 2.0]), (None, one), (11, [-1.0, -2.0, -3.0]), (12, [1e-38, 2e-38, 3e-38]),
    ]
    frame = clashing(spark.createDataFrame([(i, v, 0) for i, v in pairs], VECTOR_SCHEMA))
    assert rows(vectors.near_vectors(frame)) == brute_vectors(pairs)
    assert vectors.near_vectors(spark.createDataFrame([], VECTOR_SCHEMA)).collect() == []


def isolated_pairs(rng, n, width=16):
    """``n`` vectors and a near copy of each, most pairs far from all others."""
    x = rng.standard_normal((n, width))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = x + 0.3 / width**0.5 * rng.standard_normal(x.shape)
    return np.concatenate([x, y])


def vector_frame(spark, x):
    pairs = [(i, [float(np.float32(a)) for a in v]) for i, v in enumerate(x)]
    return pairs, spark.createDataFrame([(i, v, 0) for i, v in pairs], VECTOR_SCHEMA)


def test_oversize_shards_keep_isolated_pairs(spark, monkeypatch):
    monkeypatch.setattr(vectors, "MOST", 150)
    monkeypatch.setattr(vectors, "SHARD", 60)
    monkeypatch.setattr(vectors, "CENTRES", 2)
    monkeypatch.setattr(vectors, "OVERLAP", 3)
    pairs, frame = vector_frame(spark, isolated_pairs(np.random.default_rng(8), 500))
    got, want = rows(vectors.near_vectors(frame)), brute_vectors(pairs)
    assert sum(g[1] for g in got) >= 0.98 * sum(w[1] for w in want)


def test_shards_that_no_centres_divide_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "MOST", 50)
    monkeypatch.setattr(vectors, "BLOCK", 32)
    monkeypatch.setattr(vectors, "UNDIVIDED", 0)
    pairs, frame = vector_frame(spark, isolated_pairs(np.random.default_rng(9), 150))
    assert rows(vectors.near_vectors(frame)) == brute_vectors(pairs)


def test_recall_counts_each_vector_once(spark):
    rows_ = [(i, 1, [1.0, 0.001 * i]) for i in range(300)] + [(1000 + i, 1, [-1.0, 0.0] if i < 2 else [0.0, -1.0]) for i in range(4)]
    nodes = spark.createDataFrame(rows_, "id long, n long, vector array<double>")
    links = spark.createDataFrame([(i, 299) for i in range(300)], "id long, links long")
    assert vectors.recall(nodes, links, 0.9) == 0.0
    whole = links.unionByName(spark.createDataFrame([(1000 + i, 1) for i in range(4)], "id long, links long"))
    assert vectors.recall(nodes, whole, 0.9) == 1.0


def test_missed_links_are_completed(spark, monkeypatch):
    pairs, frame = vector_frame(spark, isolated_pairs(np.random.default_rng(10), 80))
    none = lambda *_: (spark.createDataFrame([], "id long, component long"), spark.createDataFrame([], "id long, links long"))
    monkeypatch.setattr(vectors, "_links", none)
    monkeypatch.setattr(vectors, "SLAB", 50)
    assert rows(vectors.near_vectors(frame)) == brute_vectors(pairs)


ITEM = "A train leaves Oldtown at 9 with 120 passengers and travels 300 km before Maria counts 45 empty seats in the last two cars"
SHORT = "Which river crosses seven borders"


def contaminated(spark, texts, items=((1, ITEM), (2, SHORT))):
    bench = spark.createDataFrame(list(items), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontamination.contaminated(docs(spark, list(enumerate(texts))), bench).collect()}


def test_contamination_finds_copies_and_exchanged_slots(spark):
    rng = random.Random(1)
    noise = lambda: prose(rng, 40)
    other = ITEM.replace("Oldtown", "Newburg").replace("120", "80").replace("300", "250").replace("Maria", "Ivan").replace("45", "12")
    mixed = "train leaves Oldtown at 9 with 120 passengers and travels 120 km before Maria counts 9 empty seats in the last two cars"
    got = contaminated(spark, [
        f"{noise()}. {ITEM} {noise()}", f"{noise()}. {ITEM.upper()}!! {noise()}", f"{noise()}. {other} {noise()}", noise(),
        f"{noise()} {SHORT.lower()}? {noise()}", " ".join(ITEM.split()[5:11]), f"{noise()}. {mixed}", "", None,
    ])
    assert set(got) == {(0, 1), (1, 1), (2, 1), (4, 2)}
    assert got[0, 1].coverage == 1.0 and not got[0, 1].reparameterised and got[2, 1].reparameterised


def test_one_changed_value_does_not_hide_a_copy(spark):
    rng = random.Random(6)
    item = f"{prose(rng, 20)} 5 {prose(rng, 60)} 5 cats {prose(rng, 3)} 5 {prose(rng, 20)}"
    at = item.rindex(" 5 ")
    got = contaminated(spark, [f"{prose(rng, 9)} {item[:at]} 6 {item[at + 3:]}", prose(rng, 100)], [(1, item)])
    # 5 and 6 stand for 5 in the same windows; those without the 6 are copies.
    assert set(got) == {(0, 1)} and got[0, 1].n_windows == len(item.split()) - 9 - 10 and not got[0, 1].reparameterised


def test_items_dense_in_numbers_are_found(spark):
    rng = random.Random(7)
    sums, row, short = "What is 12 + 7 - 3 * 45 + 9 - 81 + 4 * 6 - 2", "What follows 2 3 5 7 11 13", "Add 3 kg 4 kg"
    other = sums.replace("45", "46").replace("12", "13").replace("9", "8").replace("4 *", "5 *").replace("- 2", "- 3")
    texts = [f"{prose(rng, 20)}. {t} {prose(rng, 20)}" for t in (sums, row, short, other)]
    got = contaminated(spark, texts, [(1, sums), (2, row), (3, short)])
    assert set(got) == {(0, 1), (1, 2), (2, 3)} and all(r.coverage == 1.0 and not r.reparameterised for r in got.values())


def test_contamination_takes_awkward_rows(spark):
    bench = spark.createDataFrame([(1, None), (2, ""), (None, ITEM), (3, "one two"), (4, ITEM), (4, ITEM)], "item_id long, text string")
    frame = clashing(docs(spark, awkward() + [(40, ITEM), (None, ITEM), (40, ITEM)]))
    assert [(r.doc_id, r.item_id) for r in decontamination.contaminated(frame, bench).collect()] == [(40, 4)]
    empty = bench.limit(0)
    assert decontamination.contaminated(frame, empty).collect() == []
    assert decontamination.contaminated(docs(spark, []), bench).collect() == []
    left = decontamination.without_contaminated(frame, bench)
    assert left.columns == frame.columns and left.count() == len(awkward()) + 1


def test_id_filter_is_exact(spark):
    from lapsekit.llm.idfilter import bitmap, only_ids, rows_by_bitmap, without_ids

    frame = docs(spark, [(i, "t") for i in range(-50, 300)] + [(None, "t"), (7, "u")])
    ids = spark.createDataFrame([(i,) for i in range(-50, 300, 3)], "id long")
    want = [tuple(r) for r in frame.collect()]
    chosen = set(range(-50, 300, 3))
    assert rows(only_ids(frame, ids).select(*frame.columns)) == sorted((r for r in want if r[0] in chosen), key=repr)
    assert rows(without_ids(frame, ids)) == sorted((r for r in want if r[0] not in chosen), key=repr)
    assert rows(without_ids(frame, ids.limit(0))) == sorted(want, key=repr)
    crowded = bitmap(ids, 6)
    inside, outside = (rows_by_bitmap(frame, crowded, side).count() for side in (True, False))
    assert inside + outside == len(want) and inside >= len(chosen)
