"""Near-duplicate texts and vectors and repeated strings against brute force."""

from __future__ import annotations

import hashlib
import heapq
import random
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd

from ledgerline.llm import minhash, neighbours, queries, suffixes
from ledgerline.llm.common import components, groups
from llm_data import rows


def reach(nodes, links):
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


def family_texts():
    random.seed(6)
    word = lambda: "".join(random.choice("abcdefg") for _ in range(4))
    texts = [" ".join(word() for _ in range(random.randint(3, 90))) for _ in range(25)]
    for _ in range(75):
        words = random.choice(texts).split(" ")
        for _ in range(random.randint(0, 4)):
            words[random.randrange(len(words))] = word()
        texts.append((" " if random.random() < 0.2 else "") + " ".join(words).upper())
    return [*texts, None, "", "one", "One", "two words", "two  words"]


def test_near_duplicates_equal_brute_force(spark, make):
    texts = family_texts()
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set())
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    low = reach(range(len(texts)), links)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(make(texts), width=4).collect()}
    assert found == {k: (len(sets[k]), low[k]) for k in range(len(texts))}


def copies_of_one_set(n):
    """Sets that differ from one in a few values, and their signatures."""
    rng = np.random.default_rng(5)
    base, sets = rng.integers(0, 1 << 63, 200, dtype=np.uint64), []
    for _ in range(n):
        own = base.copy()
        own[rng.choice(200, rng.integers(1, 20), replace=False)] = rng.integers(0, 1 << 63, 1, dtype=np.uint64)
        sets.append(np.unique(own))
    return sets, minhash.super_min_hash(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))


def test_links_are_taken_by_falling_agreement():
    sets, signed = copies_of_one_set(60)
    for side in (np.arange(60) % 3 == 0, np.zeros(60, bool)):
        pairs = [(a, b) for b in range(60) for a in range(b) if not side.any() or side[a] != side[b]]
        agree = {p: int((signed[p[0]] == signed[p[1]]).sum()) for p in pairs}
        low, expected = list(range(60)), []
        for a, b in sorted((p for p in pairs if agree[p] >= minhash.LEAST_AGREEING), key=lambda p: (-agree[p], p)):
            if low[a] != low[b] and 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b])):
                expected.append((a, b))
                low = [low[a] if x == low[b] else x for x in low]
        assert expected and minhash.linked(sets, signed, side, 80) == expected


def test_a_large_family_takes_a_byte_a_pair():
    sets, signed = copies_of_one_set(900)
    tracemalloc.start()
    found = minhash.linked(sets, signed, np.zeros(900, bool), 80)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(found) == 899 and peak < 8 << 20  # 404,550 candidates


def test_families_larger_than_a_block(spark, make, monkeypatch):
    texts = family_texts()
    whole = rows(minhash.near_duplicates(make(texts), width=4))
    monkeypatch.setattr(minhash, "BLOCK", 3)
    assert rows(minhash.near_duplicates(make(texts), width=4)) == whole


def test_signatures_estimate_the_similarity():
    random_numbers = np.random.Generator(np.random.PCG64(8))
    errors = []
    for size in (20, 100, 1000):
        for _ in range(20):
            pool = random_numbers.integers(0, 1 << 63, size * 3 // 2, dtype=np.uint64)
            a, b = pool[:size], pool[size // 2 :]
            signed = minhash.super_min_hash(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            errors.append((signed[0] == signed[1]).mean() - true)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.045


def test_documents_without_their_copies(spark, make):
    texts = ["some words that are long enough to be compared here", "other words"] * 3
    assert rows(minhash.without_near_duplicates(make(texts)), "doc_id") == [(0,), (1,)]


def test_texts_that_share_an_id_all_stay(make):
    text, other = "a b c d e f g h", "other words entirely in this row"
    table = [(1, text, "en", "s2"), (1, other, "en", "s1"), (1, text, "en", "s1"), (2, text, "en", "s1"), (3, None, "en", "s"), (3, None, "en", "s"), (None, text, "en", "s")]
    kept = [rows(minhash.without_near_duplicates(make(t)), "doc_id", "text", "source") for t in (table, table[::-1])]
    assert kept[0] == kept[1]
    assert [r[:2] for r in kept[0]] == sorted([(1, text), (1, other), (3, None), (None, text)], key=repr)


def clustered(n=300, seed=5):
    random_numbers = np.random.Generator(np.random.PCG64(seed))
    base = random_numbers.normal(size=(n, 32))
    near = base[:60].repeat(4, axis=0) + random_numbers.normal(scale=0.15, size=(240, 32))
    hot = base[0] + random_numbers.normal(scale=0.05, size=(80, 32))
    return np.vstack([base, near, hot, base[:20], base[5:6].repeat(30, axis=0)])


def test_nn_descent_equals_brute_force(spark, monkeypatch):
    vectors = clustered()
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hit = unit @ unit.T >= 0.95
    np.fill_diagonal(hit, False)
    low = reach(range(len(vectors)), zip(*np.nonzero(hit)))
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in neighbours.near_duplicates(table).collect()}
    expected = {k: (int(hit[k].sum()), int(low[k])) for k in range(len(vectors))}
    same = sum(found[k] == expected[k] for k in expected)
    assert same >= 0.97 * len(expected)
    assert all(found[k][0] <= expected[k][0] for k in expected)


def removed_brute(texts):
    data = [(t or "").encode() for t in texts]
    count = Counter(b[k : k + 200] for b in data for k in range(len(b) - 199))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - 199):
            if count[b[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1])), hashlib.sha256(kept).hexdigest()))
    return out


def test_repeated_strings_equal_brute_force(spark, stored, monkeypatch):
    random.seed(5)
    words = ["".join(random.choice("abcdefgh") for _ in range(random.randint(2, 7))) for _ in range(300)]
    texts = [" ".join(random.choice(words) for _ in range(random.randint(5, 160))) for _ in range(25)]
    for _ in range(45):
        a, b = random.choice(texts), random.choice(texts)
        cut, start = random.randint(0, len(b)), random.randint(0, len(a))
        texts.append(b[:cut] + a[start : start + random.randint(150, 420)] + b[cut:])
    texts += ["a" * 1000, "ab" * 400 + "c" * 300, "", None, "x" * 199, "x" * 200, "é" * 150 + "z" * 100, "é" * 150 + "y" * 100, texts[3], texts[3], "\0" * 250]
    monkeypatch.setattr(suffixes, "RANGE", 50)
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in queries.QUERIES["op7_suffix_dedup"](spark, stored(texts)).collect()}
    assert found == dict(enumerate(removed_brute(texts)))


def test_loser_tree_merges_without_comparing_known_prefixes():
    random.seed(2)
    make = lambda: bytes(random.choice(b"ab") for _ in range(random.randint(0, 30)))
    for n in (1, 2, 3, 7):
        runs = [sorted(make() for _ in range(random.randint(0, 40))) for _ in range(n)]
        coded = [(r, suffixes.common_prefixes(r).tolist() if r else []) for r in runs]
        got = [(runs[r][k], p) for r, k, p in suffixes.LoserTree(coded)]
        expected = list(heapq.merge(*runs))
        assert [s for s, _ in got] == expected
        assert [p for _, p in got] == (suffixes.common_prefixes(expected).tolist() if expected else [])


def test_components_of_long_chains_and_hot_nodes(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 300)] + [(3, 3)]
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{k: 100 for k in range(100, 161)}, 7: 7, **{k: 7 for k in range(200, 300)}}


def test_groups_across_batches():
    frame = pd.DataFrame({"k": [1, 1, 2, 2, 2, 3], "v": range(6)})
    parts = [frame.iloc[:1], frame.iloc[1:3], frame.iloc[3:3], frame.iloc[3:4], frame.iloc[4:]]
    assert [g["v"].tolist() for g in groups(parts, ["k"])] == [[0, 1], [2, 3, 4], [5]]
