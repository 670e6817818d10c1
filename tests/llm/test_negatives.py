"""Hard negatives against brute force, with ties, repeated vectors and small trees."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check_oracle import compare, duck
from ledgerline.llm import negatives
from llm_data import rows


def brute(table, every=50):
    """What the contract asks for; ``table`` holds (vec_id, vector, label) rows that all take part."""
    kept = [(k, (label + 1) % 10 if k % 7 == 0 else label, np.floor(256 * np.array(v)).astype(int)) for k, v, label in table]
    out = []
    for a, own, x in kept:
        if a % every:
            continue
        scored = sorted((-int(x @ y), k, label == own) for k, label, y in kept if k != a)
        for p, positive, _ in [s for s in scored if s[2]][:5]:
            fitting = [(n, k) for n, k, same in scored if not same and -50 * p <= -100 * n <= -95 * p]
            out += [(a, positive, r, k, -p, -n) for r, (n, k) in enumerate(fitting[:3], 1)]
    return sorted(out, key=repr)


def test_query_equals_its_sql(spark, small):
    name = "op11_rtree_hard_negatives"
    status, note = compare(spark, small, name, entry.queries()[name], entry.oracle_sql()[name], duck(small))
    assert status == "ok", note


@pytest.mark.parametrize("tree_rows", [64, 100, 4096])
def test_many_ties_and_copies(spark, monkeypatch, tree_rows):
    monkeypatch.setattr(negatives, "ANCHORS", 4)
    rng = np.random.Generator(np.random.PCG64(3))
    vectors = rng.integers(-2, 4, (900, 5)) / 16
    vectors[rng.random(900) < 0.35] = [0.25, 0.125, 0.25, 0.0, 0.125]  # a third are copies
    labels = np.where(rng.random(900) < 0.4, 3, rng.integers(0, 10, 900))
    table = [(int(k), v.tolist(), int(n)) for k, v, n in zip(rng.permutation(2000)[:900], vectors, labels)]
    frame = spark.createDataFrame(table, "vec_id long, embedding array<float>, label int")
    found = rows(negatives.hard_negatives(frame, tree_rows=tree_rows))
    assert found == brute(table) and len(found) > 50


def test_every_tile_fits_a_tree(spark):
    copies = [(k, [0.5, 0.5], 1) for k in range(1000)] + [(k, [k / 999, 0.1], k % 3) for k in range(1000, 1500)]
    points = negatives.points(spark.createDataFrame(copies, "vec_id long, embedding array<float>, label int"))
    placed = negatives.tiles(points, tree_rows=128)
    assert placed.count() == 1500
    # copies are dealt by a hash, so a part holds about its share
    assert placed.groupBy("dim", "s0", "s1", "s2", "part").count().agg(F.max("count")).first()[0] <= 2 * 128


def tree_of(vectors, labels, ids):
    order = negatives.packed(vectors, labels)
    assert sorted(order.tolist()) == list(range(len(vectors)))
    return negatives.Tree(vectors.shape[1], ids[order].tobytes(), labels[order].tobytes(), vectors[order].astype("<i4").tobytes())


@pytest.mark.parametrize("size", [1, 256, 257, 5000])
def test_boxes_hold_their_rows(size):
    rng = np.random.Generator(np.random.PCG64(size))
    tree = tree_of(rng.integers(-99, 99, (size, 6)), rng.integers(0, 4, size), rng.permutation(size).astype(np.int64))
    assert len(tree.levels[-1][0]) == 1
    span = negatives.LEAF
    for low, high, least, most, ids in tree.levels:
        for k in range(len(low)):
            part = slice(k * span, (k + 1) * span)
            assert (tree.vectors[part].min(axis=0) == low[k]).all() and (tree.vectors[part].max(axis=0) == high[k]).all()
            assert (tree.labels[part].min(), tree.labels[part].max(), tree.ids[part].min()) == (least[k], most[k], ids[k])
        span *= negatives.FAN


def test_search_is_exact_and_skips_boxes():
    rng = np.random.Generator(np.random.PCG64(9))
    centres = rng.integers(-200, 200, (12, 8))
    vectors = centres[rng.integers(0, 12, 6000)] + rng.integers(-5, 6, (6000, 8))
    labels, ids = rng.integers(0, 3, 6000), rng.permutation(6000).astype(np.int64)
    halves = [tree_of(vectors[h], labels[h], ids[h]) for h in (slice(0, 3500), slice(3500, None))]
    own = np.arange(0, 6000, 200)
    scores = vectors[own] @ vectors.T
    top = scores.max(axis=1)
    low = np.stack([top // 2, np.full(30, -negatives.FAR), top // 4], axis=1)
    high = np.stack([top * 95 // 100, np.full(30, negatives.FAR), top // 3], axis=1)
    for same in (True, False):
        search = negatives.Searches(ids[own], labels[own], vectors[own], same, low, high, 3)
        for tree in halves:
            search.run(tree)
        for a, k in enumerate(own):
            fits = (labels == labels[k]) & (ids != ids[k]) if same else labels != labels[k]
            for w in range(3):
                inside = np.flatnonzero(fits & (scores[a] >= low[a, w]) & (scores[a] <= high[a, w]))
                wanted = sorted(zip((-scores[a, inside]).tolist(), ids[inside].tolist()))[:3]
                kept = [(-n, i) for n, i in zip(search.score[a, w].tolist(), search.found[a, w].tolist()) if n > -negatives.FAR]
                assert kept == wanted
        assert search.offered < 30 * 6000 * 0.8


def test_scores_beyond_doubles_are_exact():
    a = np.array([[2**30, 1, 2**30 - 1], [2**29 + 1, 2**30, 3]])
    exact = [int(sum(int(x) * int(y) for x, y in zip(r, a[0]))) for r in a]
    assert negatives.products(a.astype(np.float64), a[:1].astype(np.float64), 2**62)[:, 0].tolist() == exact


def test_odd_rows_and_clashing_columns(spark):
    table = [(0, [1.0, 0.5], 1), (1, [1.0, 0.25], 2), (2, [0.8, 0.5], 2), (3, [0.7, 0.5], 3), (50, [0.0, 0.0], 4), (51, [0.0, 0.0], 4), (52, [0.0, 0.0], 5)]
    odd = [(None, [1.0, 1.0], 1), (4, None, 1), (5, [], 1), (6, [1.0, None], 1), (8, [float("nan"), 1.0], 1), (9, [1.0, 1.0], None), (10, [1e300, 0.0], 2), (11, [1.0, 1.0, 1.0], 2)]
    frame = spark.createDataFrame(table + odd + table[:2], "vec_id long, embedding array<double>, label int")
    frame = frame.withColumns({c: F.lit("clash") for c in ("dim", "v", "score", "place", "block", "kind", "part", "k0")})
    found = rows(negatives.hard_negatives(frame))
    assert found == brute(table) and found
    assert negatives.hard_negatives(frame.limit(0)).collect() == []
