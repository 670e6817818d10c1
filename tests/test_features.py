from __future__ import annotations

import datetime as dt
import time
from pathlib import Path

import pytest
from row_sets import rows
from pyspark.sql import functions as F

from ledgerline.operators import features, forecasting, normalize
from ledgerline.operators.radix import with_chunks
from ledgerline.operators.stored import CLEAN_UP, stored_table
from ledgerline.registry import queries


def expected_history(data):
    """Walks through every customer's orders by (date, order id) and counts them."""
    days = {}
    for customer, order, day, _ in data:
        days.setdefault(customer, set()).add((day, order))
    out = []
    for customer, orders in days.items():
        walked = 0
        opened = min(day for day, _ in orders)
        for day, order in sorted(orders):
            walked += 1
            out.append((customer, order, walked, len(orders), opened, (day - opened).days))
    return sorted(out)


def history_of(df):
    return sorted(
        tuple(r)
        for r in df.select(
            "customer_id", "order_id", "customer_total_orders_to_date", "customer_lifetime_order_count",
            "customer_first_order_date", "customer_tenure_days",
        ).distinct().collect()
    )


@pytest.mark.parametrize("text_keys", [False, True])
def test_history_with_a_hot_customer_and_hot_days(spark, text_keys):
    start = dt.date(2024, 1, 1)
    data = []
    for i in range(600):
        customer = 1 if i % 3 else 2 + i % 7  # two thirds of all orders belong to one customer
        order = (i * 37) % 1009
        day = start + dt.timedelta((i * 13) % 5)
        data += [(customer, f"ORD-{order:06d}" if text_keys else order, day, 1.0)] * (1 + i % 2)
    kind = "string" if text_keys else "bigint"
    df = spark.createDataFrame(data, f"customer_id int, order_id {kind}, order_date date, sales double")
    wanted = expected_history(data)
    assert history_of(features.add_customer_features(df)) == wanted
    # Narrow chunks: the rank is then put together from many parts.
    profile = features.order_profile(df, chunk_orders=4)
    assert sorted((r[0], r[1], r[2], r[3]) for r in profile.select(
        "customer_id", "order_id", "customer_total_orders_to_date", "customer_lifetime_order_count").collect()
    ) == [w[:4] for w in wanted]


def busy_day(spark, order):
    """Two thirds of the orders belong to one customer on one day."""
    day = dt.date(2024, 1, 1)
    table = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 50 + 1).otherwise(F.lit(0)).alias("customer_id"),
        order(F.col("id")).alias("order_id"), F.lit(day).alias("order_date"), F.lit(1.0).alias("sales"),
    )
    return table


@pytest.mark.parametrize(
    "order",
    [
        lambda i: F.concat(F.lit("ORDER-2024-LONG-NAME"), F.lpad(i.cast("string"), 9, "0")),
        lambda i: F.xxhash64(i),
        lambda i: F.md5(i.cast("string")),
        lambda i: i * 1_000_003,
        lambda i: F.when(i == 1, F.lit(10**15)).when(i == 2, F.lit(-(10**15))).otherwise(i),
        lambda i: F.when(i == 1, F.lit("X1")).otherwise(F.concat(F.lit("ORD-2024-"), F.lpad(i.cast("string"), 9, "0"))),
        lambda i: F.when(i == 1, F.lit("ORD")).otherwise(F.concat(F.lit("ORD"), F.repeat(F.lit("é"), 5), i.cast("string"))),
    ],
    ids=["long common prefix", "hashed numbers", "hashed text", "sparse numbers", "far numbers", "far text", "key that begins others"],
)
def test_chunks_of_a_busy_day_are_bounded(spark, order):
    table = busy_day(spark, order)
    orders = table.groupBy("customer_id", "order_id", "order_date").agg(F.sum("sales").alias("s"))
    chunks = with_chunks(orders, ["customer_id", "order_date"], "order_id", 100).groupBy("customer_id", "order_date", "_chunk").count()
    assert chunks.agg(F.max("count")).first()[0] <= 200
    assert chunks.groupBy("customer_id", "order_date").count().agg(F.max("count")).first()[0] <= 256
    ranked = features.order_profile(table, chunk_orders=100).where("customer_id = 0").orderBy("order_id")
    assert [r[0] for r in ranked.select("customer_total_orders_to_date").collect()] == list(range(1, 4001))


def test_chunks_follow_the_order_of_the_keys(spark):
    keys = [None, *range(-300, 300, 7), 2**62, -(2**63), 2**63 - 1, *range(10**12, 10**12 + 90)]
    for kind, values in (("long", keys), ("string", ["", None, *[f"{k:x}" for k in range(1, 400, 3)], *["same" + "z" * k for k in range(30)]])):
        frame = spark.createDataFrame([(None, v) for v in values] + [(1, values[1])], f"day int, key {kind}")
        cut = with_chunks(frame, ["day"], "key", 20).cache()
        assert cut.count() == len(values) + 1
        found = cut.where("day IS NULL").orderBy("_chunk", "key").collect()
        assert [r["key"] for r in found] == [r["key"] for r in frame.where("day IS NULL").orderBy("key").collect()]
        assert cut.groupBy("day", "_chunk").count().agg(F.max("count")).first()[0] <= 40
        assert cut.where("day = 1").first()["_chunk"] == []


def test_equal_keys_stay_together(spark):
    for kind, value in (("long", 7), ("string", "seven")):
        frame = spark.createDataFrame([(1, value)] * 30, f"day int, key {kind}")
        assert with_chunks(frame, ["day"], "key", 5).select("_chunk").distinct().count() == 1


def test_two_orders_on_a_day_and_an_order_with_two_lines(spark):
    day = dt.date(2024, 5, 1)
    df = spark.createDataFrame(
        [(1, 11, day, 5.0), (1, 10, day, 5.0), (1, 10, day, 7.0), (1, 12, day + dt.timedelta(3), 1.0), (None, 99, day, 1.0)],
        "customer_id int, order_id int, order_date date, sales double",
    )
    got = features.add_customer_features(df)
    assert got.count() == 5
    assert rows(got.where("customer_id = 1").distinct(), "order_id", "customer_total_orders_to_date") == [(10, 1), (10, 1), (11, 2), (12, 3)]
    stray = got.where("order_id = 99").first()
    assert stray["customer_lifetime_order_count"] is None and stray["is_repeat_customer"] is False


def test_leaky_columns_are_tagged_and_refused(spark):
    df = spark.createDataFrame([(1, 1, dt.date(2024, 1, 1), 1.0)], "customer_id int, order_id int, order_date date, sales double")
    schema = features.add_customer_features(df).schema
    assert {f.name for f in schema if f.metadata.get("leaky")} == set(features.LEAKY_COLUMNS)
    with pytest.raises(ValueError, match="customer_lifetime_order_count"):
        forecasting.reject_leaky(["month", "customer_lifetime_order_count"])


def test_order_totals(spark):
    df = spark.createDataFrame([(1, 1500.0), (1, 500.0), (2, 10.0), (3, 20000.0)], "order_id int, sales double")
    assert rows(features.add_order_features(df).distinct(), "order_id", "order_total_sales", "order_size_category") == [
        (1, 2000.0, "Medium"), (1, 2000.0, "Medium"), (2, 10.0, "Small"), (3, 20000.0, "Large"),
    ]


def test_feature_table_keeps_rows_and_bounds(spark, small):
    from ledgerline.registry.queries import QUERIES

    table = QUERIES["feature_table"](spark, small)
    assert len(table.columns) == 37
    checked = table.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("customer_total_orders_to_date") > F.col("customer_lifetime_order_count")).alias("ahead"),
        F.count_if(F.col("customer_tenure_days") < 0).alias("early"),
        F.count_if(F.col("days_to_ship") < 0).alias("shipped_early"),
    ).first()
    assert tuple(checked) == (spark.read.parquet(f"{small}/lineitem.parquet").count(), 0, 0, 0)


def test_profiled_orders_give_the_same_feature_table(spark, small):
    """Joined to the headers or to the lines, the profile is the same; with headers the lines meet it in the view's own join."""
    from ledgerline.registry import queries

    plain_view, profiled = queries.summary(spark, small), queries.summary(spark, small, profiled=True)
    assert set(features.PROFILE_COLUMNS) <= set(profiled.columns)
    a, b = features.feature_table(plain_view), features.feature_table(profiled)
    assert set(a.columns) == set(b.columns)
    columns = [c for c in sorted(a.columns)]
    assert a.select(columns).exceptAll(b.select(columns)).isEmpty() and a.count() == b.count()


def test_stored_tables_are_read_by_column(spark):
    from ledgerline.operators.stored import stored_table

    wide = spark.range(10).selectExpr("id", "id * 2 AS double_id", "cast(id AS string) AS name")
    kept = stored_table(wide)
    assert kept.dtypes == wide.dtypes and sorted(map(tuple, kept.collect())) == sorted(map(tuple, wide.collect()))
    plan = kept.select("name")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "double_id" not in plan.split("ReadSchema")[1]
    assert stored_table(wide.limit(0)).count() == 0


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {file.name for folder in folders for file in Path(str(folder)).rglob("shuffle_*")}


def test_shuffle_files_go_with_the_step_that_is_stored(spark):
    known, setting = shuffle_files(spark), spark.conf.get(CLEAN_UP)
    frame = spark.range(1000).repartition(8, "id").groupBy((F.col("id") % 10).alias("k")).count()
    stored = stored_table(frame)
    until = time.time() + 20
    while shuffle_files(spark) - known and time.time() < until:  # they are removed in the background
        time.sleep(0.2)
    assert not shuffle_files(spark) - known
    assert rows(stored) == rows(frame) == [(k, 100) for k in range(10)]
    assert spark.conf.get(CLEAN_UP) == setting


def test_a_kept_summary_has_the_rows_of_one_plan(spark, small):
    clean = queries._clean_keyed(spark, small)
    tables = [normalize.number_items(normalize.order_items(clean)), *(f(clean) for f in (normalize.order_headers, normalize.customers, normalize.products))]
    kept = []

    def keep(df):
        kept.append(stored_table(df))
        return kept[-1]

    assert rows(normalize.order_summary(*tables, keep)) == rows(normalize.order_summary(*tables)) and len(kept) == 2
