"""The sweep over a summary against fits over all customers, and its scores against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import micro_clusters, segmentation

Z = [f"{c}_z" for c in segmentation.RFM]


def frame(spark, points):
    rows = [(k, *map(float, p)) for k, p in enumerate(points)]
    return spark.createDataFrame(rows, "customer_id long, " + ", ".join(f"{c} double" for c in Z))


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.Generator(np.random.PCG64(4))
    centres = np.array([[-2, 0, 0], [2, 0, 1], [0, 3, -1], [0, -3, 2]])
    return centres[rng.integers(0, 4, 1500)] + rng.normal(0, 0.4, (1500, 3))


def brute_scores(points, labels):
    distance = ((points[:, None] - points[None]) ** 2).sum(axis=2)
    scores = []
    for k, own in enumerate(labels):
        same = labels == own
        if same.sum() == 1 or same.all():
            scores.append(0.0)
            continue
        a = distance[k, same].sum() / (same.sum() - 1)
        b = min(distance[k, labels == c].mean() for c in set(labels) - {own})
        scores.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    cost = sum(((points[labels == c] - points[labels == c].mean(axis=0)) ** 2).sum() for c in set(labels))
    return cost, float(np.mean(scores))


def test_scores_are_those_of_brute_force(spark, blobs):
    points = np.vstack([blobs[:300], blobs[:20]])  # some repeated
    labels = {2: lambda k: k % 2, 3: lambda k: 0 if k == 7 else 1 + k % 2, 4: lambda k: k % 4, 9: lambda k: 5}
    columns = {
        2: F.col("customer_id") % 2, 3: F.when(F.col("customer_id") == 7, 0).otherwise(1 + F.col("customer_id") % 2),
        4: F.col("customer_id") % 4, 9: F.lit(5),
    }
    found = {r["clusters"]: r for r in micro_clusters.cluster_scores(frame(spark, points), columns).collect()}
    for n, label in labels.items():
        cost, score = brute_scores(points, np.array([label(k) for k in range(len(points))]))
        assert found[n]["inertia"] == pytest.approx(cost) and found[n]["silhouette"] == pytest.approx(score, abs=1e-9)
        assert found[n]["customers"] == len(points)


def test_sweep_agrees_with_fits_over_all_customers(spark, blobs):
    scaled = frame(spark, blobs).cache()
    quick = {r["clusters"]: r for r in micro_clusters.sweep_summary(scaled, [3, 4, 5], starts=5).collect()}
    full = segmentation.sweep_clusters(scaled, [3, 4, 5], starts=3)
    best = max(full, key=lambda f: f.silhouette)
    assert best.clusters == 4 and [k for k, r in quick.items() if r["is_selected"]] == [4]
    for fit in full:
        assert quick[fit.clusters]["inertia"] <= 1.02 * fit.inertia
    assert quick[4]["silhouette"] == pytest.approx(best.silhouette, abs=1e-3)


def test_the_summary_is_bounded_and_adds_up(spark, blobs):
    scaled = frame(spark, blobs)
    for limit in (20_000, 100, 1):
        cells = micro_clusters.summary(scaled, max_cells=limit)
        assert len(cells) <= limit
        assert np.allclose(cells.sum(axis=0), [len(blobs), *blobs.sum(axis=0), (blobs**2).sum()])
        centres, cost = micro_clusters.fit_summary(cells, 2)
        assert cost >= brute_scores(blobs[:1], np.zeros(1))[0] and len(centres) <= 2


def test_few_and_equal_customers(spark):
    same = frame(spark, [(1.0, 1.0, 1.0)] * 5)
    scored = micro_clusters.sweep_summary(same, [2, 3], starts=2).collect()
    assert [(r["inertia"], r["silhouette"]) for r in scored] == [(0.0, 0.0)] * 2 and sum(r["is_selected"] for r in scored) == 1
    assert micro_clusters.cluster_scores(same.limit(0), {2: F.lit(0)}).collect() == []


def test_segments_are_those_of_the_selected_count(spark, blobs):
    rows = [(k, int(abs(p[0]) * 10) + 1, int(abs(p[1]) * 9) + 1, float(abs(p[2]) * 90 + 1)) for k, p in enumerate(blobs[:400])]
    rfm = spark.createDataFrame(rows, "customer_id long, recency_days int, frequency long, monetary double")
    labelled, sweep = micro_clusters.segments_by_summary(rfm, [2, 3], starts=2)
    chosen = sweep.where("is_selected").first()["clusters"]
    assert labelled.count() == 400 and labelled.select("segment").distinct().count() == labelled.select("cluster").distinct().count() == chosen
    empty, none = micro_clusters.segments_by_summary(rfm.limit(0), [2], starts=1)
    assert empty.collect() == [] == none.collect()
