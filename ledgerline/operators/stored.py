"""Frames that are computed once and read by several consumers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Removes the shuffle files of a query when it has ended.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Else the files stay until the driver happens to collect its garbage, beside those of all later steps."""
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)


def shared_folder(spark: SparkSession) -> str:
    """What ``spark.checkpoint.dir`` names; only a local session without one gets a folder of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="ledgerline-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """The frame, computed once and kept as a checkpoint in the folder all executors share.

    A lost executor costs its running tasks, not what lies behind the checkpoint. Files go when the frame is garbage and
    the session was made with ``spark.cleaner.referenceTracking.cleanCheckpoints`` (``ledgerline.session`` sets it); else
    they stay.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored_table(df: DataFrame) -> DataFrame:
    """As ``stored``, as a Parquet table in that folder: for wide frames whose readers want different columns.

    Compressed columns take a fraction of a checkpoint's rows, and a reader takes only those it names; how the rows were
    partitioned is lost. The files stay until the folder is cleared; the shuffle files behind them go at once.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    with _shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
