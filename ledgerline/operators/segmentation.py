"""Recency, frequency and monetary value per customer, clusters and their business names."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from py4j.java_gateway import JavaObject
from pyspark import RDD, SparkContext, StorageLevel, inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.wrapper import JavaWrapper
from pyspark.mllib.common import _py2java
from pyspark.mllib.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerline.functions.numbers import half_even
from ledgerline.operators.lloyd import Refined, point_blocks, refine
from ledgerline.operators.stored import stored
from ledgerline.sources.literals import segment_action_table, segment_label_table

# Cluster counts tried, starts per count, seed, iterations, and the move of a centre that ends a fit.
CLUSTER_RANGE = range(2, 9)
STARTS = 10
SEED = 42
MAX_ITERATIONS = 300
TOLERANCE = 1e-4

#: Customers of one task of a fit. An iteration is a job of its own: with few customers in each of many tasks it only starts tasks.
ROWS_PER_TASK = 50_000

RFM = ("recency_days", "frequency", "monetary")


def customer_history(df: DataFrame) -> DataFrame:
    """Last order, distinct orders and sales of every customer, the missing one included."""
    return df.groupBy("customer_id").agg(
        F.max("order_date").alias("last_order_date"),
        F.countDistinct("order_id").alias("frequency"),
        F.sum("sales").cast("double").alias("monetary"),
    )


def _rfm(history: DataFrame, last: DataFrame) -> DataFrame:
    today = last.select(F.date_add("last_order_date", 1)).scalar()
    return history.where(F.col("customer_id").isNotNull()).select(
        "customer_id", F.datediff(today, "last_order_date").alias("recency_days"), "frequency", "monetary"
    )


def rfm(df: DataFrame) -> DataFrame:
    """Days since the last order, distinct orders and sales per customer, as of the day after the last order."""
    return _rfm(customer_history(df), df.agg(F.max("order_date").alias("last_order_date")))


def stored_rfm(df: DataFrame) -> DataFrame:
    """As ``rfm``, kept for several readers: the lines are read once, for the last day too."""
    history = stored(customer_history(df))
    return _rfm(history, history.agg(F.max("last_order_date").alias("last_order_date")))


def fit_scaling(rfm_rows: DataFrame) -> DataFrame:
    """(measure, mean, std) of the logarithms, with the population deviation: what new customers are scaled by."""
    logs = rfm_rows.select(*[F.log1p(c).alias(c) for c in RFM])
    wide = logs.agg(*[F.struct(F.lit(c).alias("measure"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in RFM])
    return wide.select(F.inline(F.array(*RFM)))


def scale(rfm_rows: DataFrame, scaling: DataFrame | None = None) -> DataFrame:
    """log1p, then z-scores by the given scaling or by the rows' own; a constant column becomes zero."""
    scaling = fit_scaling(rfm_rows) if scaling is None else scaling
    fitted = scaling.agg(F.map_from_entries(F.collect_list(F.struct("measure", F.struct("mean", "std"))))).scalar()

    def z(c: str) -> Column:
        std = fitted[c]["std"]
        return (F.log1p(c) - fitted[c]["mean"]) / F.when(std == 0, F.lit(1.0)).otherwise(std)

    return rfm_rows.select("customer_id", *[z(c).alias(f"{c}_z") for c in RFM])


def _assembled(scaled: DataFrame) -> DataFrame:
    assembler = VectorAssembler(inputCols=[f"{c}_z" for c in RFM], outputCol="features")
    return assembler.transform(scaled)


def _vectors(scaled: DataFrame) -> DataFrame:
    return _assembled(scaled).select("customer_id", "features")


@dataclass
class ClusterFit:
    clusters: int
    model: KMeansModel
    inertia: float
    silhouette: float


def packed(rows: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The rows, cached in as many partitions as their number asks for, and no more than they came in."""
    spread = rows.persist()
    try:
        few = spread.coalesce(max(1, -(-spread.count() // rows_per_task))).persist()
        few.count()
        return few
    finally:
        spread.unpersist()


def _kmeans(clusters: int, start: int) -> KMeans:
    return KMeans(
        k=clusters, seed=SEED + start, maxIter=MAX_ITERATIONS, tol=TOLERANCE, featuresCol="features", predictionCol="cluster"
    )


def _rdd_of_vectors(blocks: RDD) -> JavaObject:
    """The points as MLlib's vectors, cached in the executors: fits then decode no columns."""
    vectors = blocks.flatMap(lambda points: map(Vectors.dense, points.T))
    return _py2java(blocks.ctx, vectors).rdd().persist(blocks.ctx._getJavaStorageLevel(StorageLevel.MEMORY_AND_DISK_DESER))


def _first_centres(vectors: JavaObject, clusters: int, start: int) -> np.ndarray:
    """The centres that MLlib's k-means|| chooses for a start: a fit without iterations."""
    means = SparkContext.getOrCreate()._jvm.org.apache.spark.mllib.clustering.KMeans
    model = means.train(vectors, clusters, 0, "k-means||", SEED + start)
    return np.array([list(c.toArray()) for c in model.clusterCenters()], np.float64)


def _model(clusters: int, start: int, fit: Refined) -> KMeansModel:
    """The fit as a model of MLlib: it assigns customers, is saved and loaded."""
    context = SparkContext.getOrCreate()
    centres = [_py2java(context, Vectors.dense(c)) for c in fit.centres]
    vectors = JavaWrapper._new_java_array(centres, context._jvm.org.apache.spark.mllib.linalg.Vector)
    parts = JavaWrapper._new_java_obj("org.apache.spark.mllib.clustering.KMeansModel", vectors, "euclidean", fit.cost, fit.iterations)
    kmeans = _kmeans(clusters, start)
    model = KMeansModel(JavaWrapper._new_java_obj("org.apache.spark.ml.clustering.KMeansModel", kmeans.uid, parts))
    return kmeans._copyValues(model)


def sweep_clusters(
    scaled: DataFrame, clusters: Iterable[int] = CLUSTER_RANGE, starts: int = STARTS, parallelism: int = 8
) -> list[ClusterFit]:
    """For every cluster count the model with the lowest cost out of several seeded starts.

    The starts are independent jobs over one cached frame and are submitted side by side, as are the scores. All fits then
    move together: a pass over all customers is one step of every fit that has not settled. Only costs, scores, sums per
    cluster and centres reach the driver. Costs that agree to twelve digits are equal, and the first start wins.
    """
    vectors = packed(_assembled(scaled))
    points = point_blocks(vectors.select(*[f"{c}_z" for c in RFM]))
    seeded = _rdd_of_vectors(points)
    evaluator = ClusteringEvaluator(predictionCol="cluster", featuresCol="features")
    runs = [(k, start) for k in clusters for start in range(starts)]
    try:
        with ThreadPool(parallelism) as pool:
            on_session = inheritable_thread_target(vectors.sparkSession)
            seeded.count()
            first = pool.map(on_session(lambda run: _first_centres(seeded, *run)), runs, chunksize=1)
            fits = dict(zip(runs, refine(points, first, MAX_ITERATIONS, TOLERANCE)))
            best = [min((r for r in runs if r[0] == k), key=lambda r: float(f"{fits[r].cost:.12g}")) for k in dict.fromkeys(k for k, _ in runs)]
            models = [_model(*run, fits[run]) for run in best]
            scores = pool.map(on_session(lambda model: evaluator.evaluate(model.transform(vectors))), models, chunksize=1)
        return [ClusterFit(run[0], model, fits[run].cost, score) for run, model, score in zip(best, models, scores)]
    finally:
        seeded.unpersist(False)
        points.unpersist()
        vectors.unpersist()


def sweep_table(scaled: DataFrame, fits: list[ClusterFit]) -> DataFrame:
    best = max(fits, key=lambda f: f.silhouette).clusters
    rows = [(f.clusters, float(f.inertia), float(f.silhouette), f.clusters == best) for f in fits]
    return scaled.sparkSession.createDataFrame(
        rows, "clusters int, inertia double, silhouette double, is_selected boolean"
    )


def assign_clusters(rfm_rows: DataFrame, scaled: DataFrame, model: KMeansModel) -> DataFrame:
    """The RFM rows with their cluster, matched by customer."""
    assigned = model.transform(_vectors(scaled)).select("customer_id", "cluster")
    return rfm_rows.join(assigned, "customer_id")


def fit_checks(scaled: DataFrame, fits: list[ClusterFit], tolerance: float = 1e-6) -> DataFrame:
    """What must hold of every fit, from one pass over the customers: all are assigned, each to the nearest centre, the
    cost is the sum of the squared distances, and one cluster count is selected."""
    best = max(fits, key=lambda f: f.silhouette).clusters
    assigned = _vectors(scaled)
    for fit in fits:
        assigned = fit.model.transform(assigned).withColumnRenamed("cluster", f"_c{fit.clusters}")
    assigned = assigned.join(scaled, "customer_id")
    figures = []
    for fit in fits:
        squares = [reduce(Column.__add__, [F.pow(F.col(f"{c}_z") - float(x), 2) for c, x in zip(RFM, centre)]) for centre in fit.model.clusterCenters()]
        own, least = F.get(F.array(*squares), F.col(f"_c{fit.clusters}")), F.least(*squares)
        figures.append(
            F.struct(
                F.lit(fit.clusters).alias("clusters"), F.count(own).alias("customers"), F.count_if(own > least + tolerance).alias("not_nearest"),
                (F.abs(F.sum(own) - fit.inertia) <= tolerance * fit.inertia).alias("inertia_matches"),
                F.lit(sum(f.clusters == best for f in fits)).alias("selected"),
            )
        )
    return assigned.agg(F.array(*figures).alias("f")).select(F.inline("f"))


def score_customers(rfm_rows: DataFrame, scaling: DataFrame, model: KMeansModel) -> DataFrame:
    """Customers that the model has not seen, scaled as its training rows were, with their cluster."""
    return assign_clusters(rfm_rows, scale(rfm_rows, scaling), model)


def _average_rank(column: str, ascending: bool) -> Column:
    """Rank whose ties share the mean of their positions. Clusters are few: one small window."""
    order = F.col(column).asc() if ascending else F.col(column).desc()
    ties = F.count("*").over(W.partitionBy(column))
    return F.rank().over(W.orderBy(order)) + (ties - 1) / F.lit(2.0)


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """Mean recency, frequency and monetary value per cluster with ranks and the segment name."""
    profile = clustered.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in RFM])
    return name_segments(profile)


def name_segments(profile: DataFrame) -> DataFrame:
    """Segment names by the order of the summed ranks; the cluster number breaks ties."""
    ranked = profile.withColumns(
        {
            "recency_rank": _average_rank("recency_days", True),
            "frequency_rank": _average_rank("frequency", False),
            "monetary_rank": _average_rank("monetary", False),
        }
    ).withColumn("composite_rank", F.col("recency_rank") + F.col("frequency_rank") + F.col("monetary_rank"))
    placed = ranked.withColumns(
        {
            "position": F.row_number().over(W.orderBy("composite_rank", "cluster")),
            "clusters": F.count("*").over(W.partitionBy()).cast("int"),
        }
    )
    # A fixed table of a few dozen literal rows.
    labels = F.broadcast(segment_label_table(profile.sparkSession))
    named = placed.join(labels, ["clusters", "position"], "left")
    fallback = F.concat(F.lit("Segment "), F.col("position").cast("string"))
    return named.select(
        "cluster", *RFM, "recency_rank", "frequency_rank", "monetary_rank", "composite_rank",
        F.coalesce("label", fallback).alias("segment"),
    )


def label_customers(clustered: DataFrame) -> DataFrame:
    """Every customer with its segment."""
    names = cluster_profile(clustered).select("cluster", "segment")
    return clustered.join(names, "cluster", "left").select("customer_id", *RFM, "cluster", "segment")


def segment_sizes(labelled: DataFrame) -> DataFrame:
    """Customers and mean values per segment with the recommended action."""
    sizes = labelled.groupBy("segment").agg(
        F.count("*").alias("customers"), *[half_even(F.avg(c), 1).alias(c) for c in RFM]
    )
    actions = F.broadcast(segment_action_table(labelled.sparkSession))
    return sizes.join(actions, "segment", "left").orderBy(F.desc("customers"), "segment")


def segment_points(labelled: DataFrame) -> DataFrame:
    """Scatter data: frequency against monetary value, larger points for recent customers."""
    size = F.lit(300.0) / (F.col("recency_days") + 10)
    return labelled.select("customer_id", "segment", "frequency", "monetary", size.alias("point_size"))
