"""File and table sources and sinks: CSV, Parquet, catalog tables, JDBC."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F, types as T

from ledgerline.schemas import ORDER_LINE_SCHEMA, RAW_TEXT_SCHEMA


class MissingInputError(FileNotFoundError):
    """An input path does not exist; the message names the stage that writes it."""


def _load(read, path: str, produced_by: str) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if (error.getCondition() or "").startswith("PATH_NOT_FOUND"):
            raise MissingInputError(f"{path} does not exist: run the '{produced_by}' stage first") from error
        raise


def read_raw_csv(spark: SparkSession, path: str, produced_by: str = "collect") -> DataFrame:
    """Raw order lines, every column as text, ready for ``convert_types``."""
    return _load(lambda: spark.read.schema(RAW_TEXT_SCHEMA).option("header", True).csv(path), path, produced_by)


def read_typed_csv(
    spark: SparkSession, path: str, schema: T.StructType = ORDER_LINE_SCHEMA, produced_by: str = "clean"
) -> DataFrame:
    """CSV with a declared schema, dates included: no inference pass over the file."""
    return _load(lambda: spark.read.schema(schema).option("header", True).csv(path), path, produced_by)


def read_parquet(spark: SparkSession, path: str, produced_by: str) -> DataFrame:
    return _load(lambda: spark.read.parquet(path), path, produced_by)


def read_query(spark: SparkSession, statement: str) -> DataFrame:
    """SQL over the views and tables of the session catalog."""
    return spark.sql(statement)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 64,
    single_task: bool = False,
    **options: str,
) -> DataFrame:
    """Database table or view, read in ranges of the partition column by many tasks.

    Only a table that is known to be small may be read through one task, and only when asked for.
    """
    if not partition_column and not single_task:
        raise ValueError("name a partition column with its bounds, or ask for a single task")
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column:
        lower, upper = bounds or (None, None)
        if lower is None:
            raise ValueError("a partitioned read needs the bounds of the partition column")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", partitions)
        )
    return reader.load()


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_table(df: DataFrame, table: str) -> None:
    """Append to a table that already exists, matching columns by name. Repeating it doubles the rows: see ``append_batch``."""
    df.select(*df.sparkSession.table(table).columns).write.insertInto(table)


#: Column that tells which load a row of a batched table came with.
BATCH_COLUMN = "batch_id"


def append_batch(df: DataFrame, table: str, batch: str) -> None:
    """Make the rows of one batch in a table partitioned by ``batch_id`` those of the frame, whatever they were before.

    Only that batch's partition is replaced, when its new files are complete: a load that failed or was done before can be
    repeated and neither doubles rows nor touches other batches. An empty frame leaves the batch without rows.
    """
    spark = df.sparkSession
    layout = spark.catalog.listColumns(table)
    if [c.name for c in layout if c.isPartition] != [BATCH_COLUMN]:
        raise ValueError(f"{table} must be partitioned by {BATCH_COLUMN} alone")
    if df.isEmpty():
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({BATCH_COLUMN} = :batch)", args={"batch": batch})
        return
    named = df.withColumn(BATCH_COLUMN, F.lit(batch)).select(*[F.col(c.name).cast(c.dataType).alias(c.name) for c in layout])
    with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        named.write.insertInto(table, overwrite=True)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def storage(spark: SparkSession, table: str) -> tuple[str, str]:
    """(provider, location) of a catalog table that is kept in files."""
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return facts["Provider"], facts["Location"]


def reload_tables(tables: Mapping[str, DataFrame]) -> None:
    """Replace the rows of the named catalog tables, parents listed first, by those of the frames.

    Every frame is first written whole to a new folder beside its table's present one. Only when all of them are there do
    the tables change over, each by one entry in the catalog: parents before the children that refer to them. A load that fails
    while it writes has changed no table; one that fails between two entries is completed by repeating it. Running it
    twice leaves the same rows. Frames may read the tables they replace. Former folders stay for readers that are
    still at work; ``drop_former_folders`` removes them.
    """
    folders = {}
    for name, df in tables.items():
        spark, layout = df.sparkSession, df.sparkSession.catalog.listColumns(name)
        if any(c.isPartition for c in layout):
            raise ValueError(f"{name} is partitioned: load it by batches")
        provider, location = storage(spark, name)
        folders[name] = f"{_first_folder(location)}{_LOAD}{uuid.uuid4().hex}"
        df.select(*[F.col(c.name).cast(c.dataType).alias(c.name) for c in layout]).write.format(provider).save(folders[name])
    for name, df in tables.items():
        _change_over(df.sparkSession, name, folders[name])


#: Ends the name of a table's first folder in the names of the folders that follow it.
_LOAD = "__load-"


def _first_folder(location: str) -> str:
    return location.rstrip("/").split(_LOAD)[0]


def _change_over(spark: SparkSession, table: str, folder: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)


def drop_former_folders(spark: SparkSession, table: str) -> list[str]:
    """Remove the folders that a reloaded table has left, and those of loads that failed; returns what is gone."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    present = path(storage(spark, table)[1])
    first = _first_folder(present.toString())
    fs = present.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for pattern in (first, f"{first}{_LOAD}*") for s in fs.globStatus(path(pattern)) or []]
    gone = [p for p in found if p.getName() != present.getName()]
    for p in gone:
        fs.delete(p, True)
    return [p.getName() for p in gone]


def reload_jdbc(tables: Mapping[str, DataFrame], url: str, batch_size: int = 500, **options: str) -> None:
    """As ``reload_tables`` for tables of a database: emptied in place, so that keys and references stay declared."""
    for name in reversed(tables):
        jdbc_writer(tables[name].limit(0), url, name, batch_size, **options).option("truncate", True).mode("overwrite").save()
    for name, df in tables.items():
        jdbc_writer(df, url, name, batch_size, **options).mode("append").save()


def jdbc_writer(df: DataFrame, url: str, table: str, batch_size: int, **options: str) -> DataFrameWriter:
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    return writer.options(**options)


def append_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 500, **options: str) -> None:
    jdbc_writer(df, url, table, batch_size, **options).mode("append").save()
