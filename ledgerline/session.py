"""Spark session construction."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: Settings the library relies on. All of them can be overridden by the cluster.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Joins back to the order lines meet hot orders and hot products: let AQE split those partitions.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Frames that were stored for several readers go with the last of them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app_name: str = "ledgerline", **conf: str) -> SparkSession:
    """Session for a cluster job: the master and the sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(app_name: str = "ledgerline-local", cores: int | None = None, **conf: str) -> SparkSession:
    """Session for tests and the benchmark: one JVM, as many threads as asked for."""
    cores = cores or os.cpu_count() or 1
    settings = {
        **RECOMMENDED_CONF,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("LEDGERLINE_DRIVER_MEMORY", "8g"),
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
