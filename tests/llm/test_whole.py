"""Cases in which an operator once did less than its whole job."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ledgerline.llm import neighbours, suffixes


def normal(seed, *shape):
    return np.random.Generator(np.random.PCG64(seed)).normal(size=shape)


def linked(vectors):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hit = unit @ unit.T >= 0.95
    np.fill_diagonal(hit, False)
    return hit


def near_duplicates(spark, vectors):
    frame = pd.DataFrame({"vec_id": np.arange(len(vectors)), "embedding": vectors.tolist()})
    return neighbours.near_duplicates(spark.createDataFrame(frame, "vec_id long, embedding array<double>")).orderBy("vec_id").toPandas()


def test_rare_links_of_a_large_table_are_found(spark):
    base = normal(3, 16_000, 64)
    vectors = np.vstack([base, base[:60] + 0.31 * normal(4, 60, 64)])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    true = (unit[:60] * unit[-60:]).sum(axis=1) >= 0.95
    found = near_duplicates(spark, vectors)
    assert true.sum() > 30
    assert found["n_links"][:60][true].sum() >= neighbours.RECALL * true.sum()


def test_orders_grow_with_the_table():
    few, many = (neighbours.order_sizes(n, 0.95) for n in (1000, 1_000_000))
    assert many[0] > few[0] and many[1] > few[1]


def test_failed_audits_end_in_exact_blocks(spark, monkeypatch):
    base = normal(5, 150, 32)
    vectors = np.vstack([base, base[:50] + 0.1 * normal(6, 50, 32)])
    monkeypatch.setattr(neighbours, "audited", lambda *a: (100, 0))
    monkeypatch.setattr(neighbours, "SLACK", -1.0)
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    assert near_duplicates(spark, vectors)["n_links"].tolist() == linked(vectors).sum(axis=1).tolist()


def nested_groups():
    """Ten pairs of tight sets of 20, at 0.99 inside and about 0.955 across."""
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    a, b = unit(normal(7, 10, 64)), unit(normal(8, 10, 64))
    b = unit(b - (a * b).sum(axis=1, keepdims=True) * a)
    centres = np.concatenate([a, 0.965 * a + np.sqrt(1 - 0.965**2) * b])
    return centres.repeat(20, axis=0) + normal(9, 400, 64) * 0.1005 / 8


def test_lists_full_of_copies_hide_no_family(spark, monkeypatch):
    vectors = nested_groups()
    hit = linked(vectors)
    monkeypatch.setattr(neighbours, "audited", lambda *a: (0, 0))
    found = near_duplicates(spark, vectors)
    assert found["n_links"].tolist() == hit.sum(axis=1).tolist()
    assert found["component_id"].tolist() == [k % 200 // 20 * 20 for k in range(400)]


def uncovered(texts, length=200):
    """What is left of each text, by brute force."""
    data = [t.encode() for t in texts]
    seen = {}
    for t in data:
        for k in range(len(t) - length + 1):
            seen[t[k : k + length]] = seen.get(t[k : k + length], 0) + 1
    out = []
    for t in data:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = True
        out.append(np.frombuffer(t, np.uint8)[~gone].tobytes())
    return out


def test_shared_passage_with_many_borders_is_split(spark, make, monkeypatch):
    random.seed(11)
    word = lambda n: "".join(random.choice("abcdefgh ") for _ in range(n))
    passage, tails = word(160), [word(60) for _ in range(6)]
    texts = [word(220) + passage + word(220) for _ in range(150)]
    texts += [word(220) + passage + random.choice(tails) + word(220) for _ in range(60)]
    merged, sizes = suffixes.merged, []

    def measured(runs):
        sizes.append(runs.groupBy("part").agg(F.sum(F.length("low")).alias("n")).agg(F.max("n")).first()[0])
        return merged(runs)

    monkeypatch.setattr(suffixes, "merged", measured)
    monkeypatch.setattr(suffixes, "RANGE", 20)
    monkeypatch.setattr(suffixes, "HOT", 20, raising=False)
    found = {r["doc_id"]: bytes(r["kept"]) for r in suffixes.without_repeats(make(texts)).collect()}
    assert found == dict(enumerate(uncovered(texts)))
    assert any(len(found[k]) < len(t) for k, t in enumerate(texts))
    assert (sizes[0] or 0) <= 60, sizes
