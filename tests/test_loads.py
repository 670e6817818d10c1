"""Loads that fail between their steps and are repeated."""

from __future__ import annotations

import uuid

import pytest
from row_sets import rows
from pyspark.sql import functions as F

from ledgerline.sources import files


@pytest.fixture()
def table(spark):
    names = []

    def create(columns, partitioned=""):
        name = f"load_{uuid.uuid4().hex[:8]}"
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {partitioned}")
        names.append(name)
        return name

    yield create
    for name in names:
        files.drop_former_folders(spark, name)
        spark.sql(f"DROP TABLE {name}")


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "a int")


def failing(df):
    """The frame, whose last row ends the job when it is computed."""
    largest = df.agg(F.max("a")).first()[0]
    return df.repartition(3).withColumn("a", F.when(F.col("a") == largest, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("a")))


def test_a_repeated_batch_replaces_itself_only(spark, table):
    name = table("a INT, batch_id STRING", "PARTITIONED BY (batch_id)")
    for _ in range(2):
        files.append_batch(numbers(spark, 1, 2), name, "monday")
        files.append_batch(numbers(spark, 3), name, "tuesday")
    assert rows(spark.table(name)) == [(1, "monday"), (2, "monday"), (3, "tuesday")]
    files.append_batch(numbers(spark, 4, 5), name, "tuesday")
    assert rows(spark.table(name)) == [(1, "monday"), (2, "monday"), (4, "tuesday"), (5, "tuesday")]
    files.append_batch(numbers(spark), name, "monday")
    assert rows(spark.table(name)) == [(4, "tuesday"), (5, "tuesday")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_a_failed_batch_leaves_its_former_rows(spark, table):
    name = table("a INT, batch_id STRING", "PARTITIONED BY (batch_id)")
    files.append_batch(numbers(spark, 1, 2), name, "monday")
    with pytest.raises(Exception, match="lost"):
        files.append_batch(failing(numbers(spark, *range(50))), name, "monday")
    assert rows(spark.table(name)) == [(1, "monday"), (2, "monday")]
    files.append_batch(numbers(spark, *range(3)), name, "monday")
    assert rows(spark.table(name), "a") == [(0,), (1,), (2,)]


def test_batches_need_their_partition(spark, table):
    with pytest.raises(ValueError, match="partitioned by batch_id"):
        files.append_batch(numbers(spark, 1), table("a INT, batch_id STRING"), "x")


def test_a_reload_that_fails_while_it_writes_changes_no_table(spark, table):
    parent, child = table("a INT"), table("a INT, b STRING")
    old = {parent: numbers(spark, 1, 2), child: numbers(spark, 1).withColumn("b", F.lit("x"))}
    files.reload_tables(old)
    new = {parent: numbers(spark, 7, 8, 9), child: numbers(spark, *range(20)).withColumn("b", F.lit("y"))}
    with pytest.raises(Exception, match="lost"):
        files.reload_tables(new | {child: failing(new[child])})
    assert rows(spark.table(parent)) == [(1,), (2,)] and rows(spark.table(child)) == [(1, "x")]
    for _ in range(2):
        files.reload_tables(new)
        assert rows(spark.table(parent)) == [(7,), (8,), (9,)] and spark.table(child).count() == 20


def test_a_reload_that_fails_between_two_tables_is_completed_by_repeating(spark, table, monkeypatch):
    parent, child = table("a INT"), table("a INT")
    files.reload_tables({parent: numbers(spark, 1), child: numbers(spark, 1)})
    new = {parent: numbers(spark, 1, 2), child: numbers(spark, 2, 2)}
    change, done = files._change_over, []

    def once(session, name, folder):
        if done:
            raise OSError("catalog is away")
        done.append(change(session, name, folder))

    monkeypatch.setattr(files, "_change_over", once)
    with pytest.raises(OSError):
        files.reload_tables(new)
    # Parents go first: no child can refer to a row that is not there.
    assert rows(spark.table(parent)) == [(1,), (2,)] and rows(spark.table(child)) == [(1,)]
    monkeypatch.setattr(files, "_change_over", change)
    files.reload_tables(new)
    assert rows(spark.table(parent)) == [(1,), (2,)] and rows(spark.table(child)) == [(2,), (2,)]


def test_a_table_can_be_reloaded_from_itself_and_former_folders_go(spark, table):
    name = table("a INT")
    files.append_table(numbers(spark, 1, 2), name)
    for _ in range(3):
        files.reload_tables({name: spark.table(name).select((F.col("a") * 2).alias("a"))})
    assert rows(spark.table(name)) == [(16,), (8,)]
    assert len(files.drop_former_folders(spark, name)) == 3
    assert files.drop_former_folders(spark, name) == [] and spark.table(name).count() == 2


def test_a_partitioned_table_is_not_reloaded_whole(spark, table):
    name = table("a INT, batch_id STRING", "PARTITIONED BY (batch_id)")
    with pytest.raises(ValueError, match="by batches"):
        files.reload_tables({name: numbers(spark, 1).withColumn("batch_id", F.lit("x"))})
