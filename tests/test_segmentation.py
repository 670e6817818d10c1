from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans, KMeansModel
from row_sets import rows

from ledgerline.operators import lloyd, segmentation
from ledgerline.sources.literals import SEGMENT_LABELS


def test_recency_counts_from_the_day_after_the_last_order(spark):
    df = spark.createDataFrame(
        [(1, 10, dt.date(2024, 1, 1), 5.0), (1, 10, dt.date(2024, 1, 1), 6.0), (1, 11, dt.date(2024, 1, 9), 1.0), (2, 12, dt.date(2024, 1, 3), 2.0)],
        "customer_id int, order_id int, order_date date, sales double",
    )
    assert rows(segmentation.rfm(df)) == [(1, 1, 2, 12.0), (2, 7, 1, 2.0)]


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1, 1, 3, 10.0), (2, 5, 3, 100.0)], "customer_id int, recency_days int, frequency bigint, monetary double")
    got = {r["customer_id"]: r for r in segmentation.scale(df).collect()}
    assert got[1]["recency_days_z"] == pytest.approx(-1.0) and got[2]["monetary_z"] == pytest.approx(1.0)
    assert got[1]["frequency_z"] == 0.0  # constant column


def profile(spark, k):
    # Cluster 0 is best in everything, cluster k-1 worst.
    data = [(c, float(10 + c), float(100 - c), float(1000 - c)) for c in range(k)]
    return spark.createDataFrame(data, "cluster int, recency_days double, frequency double, monetary double")


@pytest.mark.parametrize("k", [2, 3, 4, 5, 6, 7, 8, 9])
def test_label_sets(spark, k):
    named = segmentation.name_segments(profile(spark, k)).orderBy("cluster").collect()
    assert [r["segment"] for r in named] == SEGMENT_LABELS.get(k, [f"Segment {i + 1}" for i in range(k)])


def test_ties_share_the_mean_rank_and_the_cluster_decides(spark):
    data = [(5, 1.0, 2.0, 3.0), (3, 1.0, 2.0, 3.0), (1, 2.0, 1.0, 1.0)]
    named = segmentation.name_segments(spark.createDataFrame(data, "cluster int, recency_days double, frequency double, monetary double"))
    got = {r["cluster"]: r for r in named.collect()}
    assert [got[c]["recency_rank"] for c in (3, 5, 1)] == [1.5, 1.5, 3.0]
    assert [got[c]["segment"] for c in (3, 5, 1)] == ["Champions", "At Risk", "Lost"]


def test_sweep_finds_separate_groups_and_repeats(spark):
    centres = [(2, 2, 50.0), (400, 40, 90000.0)]
    data = [(i, r + i % 3, f + i % 2, m + i) for i in range(60) for r, f, m in [centres[i % 2]]]
    rows_ = spark.createDataFrame(data, "customer_id int, recency_days int, frequency int, monetary double")
    scaled = segmentation.scale(rows_)
    fits = segmentation.sweep_clusters(scaled, clusters=[2, 3], starts=2)
    table = {r["clusters"]: r for r in segmentation.sweep_table(scaled, fits).collect()}
    assert table[2]["is_selected"] and table[3]["inertia"] <= table[2]["inertia"]
    labelled = segmentation.label_customers(segmentation.assign_clusters(rows_, scaled, fits[0].model))
    sizes = segmentation.segment_sizes(labelled).collect()
    assert sorted(r["customers"] for r in sizes) == [30, 30] and all(r["action"] for r in sizes)
    again = segmentation.sweep_clusters(scaled, clusters=[2], starts=2)
    assert math.isclose(again[0].inertia, fits[0].inertia, rel_tol=1e-9)
    point = segmentation.segment_points(labelled).where("customer_id = 0").first()
    assert point["point_size"] == 300.0 / 12


def test_fits_run_in_as_few_tasks_as_the_customers_need(spark):
    rows = spark.range(1000).selectExpr("id AS customer_id").repartition(16)
    few = segmentation.packed(rows, rows_per_task=300)
    assert few.rdd.getNumPartitions() == 4 and few.distinct().count() == 1000
    assert segmentation.packed(rows, rows_per_task=10).rdd.getNumPartitions() == 16
    assert segmentation.packed(rows.limit(0)).count() == 0


Z = [f"{c}_z" for c in segmentation.RFM]


def cloud(spark, count=900):
    rng = np.random.Generator(np.random.PCG64(7))
    points = rng.normal(0, 1, (count, 3)) + 1.5 * rng.integers(0, 3, (count, 1))
    return spark.createDataFrame([(k, *map(float, p)) for k, p in enumerate(points)], "customer_id long, " + ", ".join(f"{z} double" for z in Z)).coalesce(1).cache()


def test_shared_passes_end_where_single_fits_do(spark, tmp_path):
    scaled = cloud(spark)
    fits = segmentation.sweep_clusters(scaled, clusters=[2, 5], starts=3)
    for fit in fits:
        alone = [
            KMeans(k=fit.clusters, seed=segmentation.SEED + s, maxIter=segmentation.MAX_ITERATIONS, predictionCol="cluster").fit(segmentation._vectors(scaled))
            for s in range(3)
        ]
        best = min(alone, key=lambda m: m.summary.trainingCost)
        assert fit.inertia == pytest.approx(best.summary.trainingCost, rel=1e-9)
        assert np.allclose(fit.model.clusterCenters(), best.clusterCenters(), atol=1e-9)
        fit.model.write().overwrite().save(str(tmp_path / "model"))
        assigned = KMeansModel.load(str(tmp_path / "model")).transform(segmentation._vectors(scaled))
        assert rows(assigned, "customer_id", "cluster") == rows(best.transform(segmentation._vectors(scaled)), "customer_id", "cluster")


def test_a_pass_serves_all_fits(spark):
    blocks = lloyd.point_blocks(cloud(spark).select(*Z))
    starts = [np.array(blocks.first()[:, s : s + k].T) for k in (2, 3, 4) for s in range(0, 40, 5)]
    spark.sparkContext.setJobGroup("refine", "passes of the fits")
    try:
        fits = lloyd.refine(blocks, starts, 300, 1e-4)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("refine"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs == 1 + max(f.iterations for f in fits) < sum(f.iterations for f in fits)
    assert [f.cost for f in lloyd.refine(blocks, starts[:1], 300, 1e-4)] == pytest.approx([fits[0].cost], rel=1e-9)


def test_equally_near_centres_and_centres_without_points(spark):
    frame = spark.createDataFrame([(x, 0.0, 0.0) for x in (-1.0, 0.0, 1.0)], ", ".join(f"{z} double" for z in Z)).coalesce(1)
    blocks = lloyd.point_blocks(frame)
    near = np.array([[-1.0, 0, 0], [1.0, 0, 0], [50.0, 0, 0], [1.0, 0, 0]])
    (sums,) = lloyd._sums(blocks.collect(), [near])
    assert sums[:, 3].tolist() == [2, 1, 0, 0] and sums[:, 0].tolist() == [-1, 1, 0, 0]
    (fit,) = lloyd.refine(blocks, [near], 300, 1e-4)
    assert fit.centres[:, 0].tolist() == [-0.5, 1.0, 50.0, 1.0] and fit.cost == 0.5


def test_stored_measures_are_the_same_and_count_lines_without_a_customer(spark):
    df = spark.createDataFrame(
        [(1, 10, dt.date(2024, 1, 1), 5.0), (1, 11, dt.date(2024, 1, 9), 1.0), (2, 12, dt.date(2024, 1, 3), 2.0), (None, 13, dt.date(2024, 2, 1), 1.0)],
        "customer_id int, order_id int, order_date date, sales double",
    )
    assert rows(segmentation.stored_rfm(df)) == rows(segmentation.rfm(df)) == [(1, 24, 2, 6.0), (2, 30, 1, 2.0)]
