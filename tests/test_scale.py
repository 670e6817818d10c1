"""Plans and results under the conditions of a large cluster: nothing broadcast by size, hot keys."""

from __future__ import annotations

import datetime as dt
import math
import random
import re
import struct
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import baskets, cleaning, features, normalize, quantiles, statistics
from ledgerline.operators.joins import join_per_key
from ledgerline.registry.queries import QUERIES, dirty

MODELS = {"k_sweep", "k_sweep_checks", "kmeans_segments", "model_comparison", "model_checks", "actual_vs_predicted", "fitted_forecast_report"}


@contextmanager
def conf(spark, **settings):
    old = {k.replace("__", "."): spark.conf.get(k.replace("__", "."), None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k.replace("__", "."), v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODELS))
def test_no_nested_loop_join_when_tables_are_large(spark, small, name):
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = plan_of(QUERIES[name](spark, small))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)


def hot_lines(spark):
    """Half of the lines belong to one order of one customer."""
    day = dt.date(2024, 1, 1)
    return spark.range(40000).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("order_id"),
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("customer_id"),
        F.when(F.col("id") % 2 == 0, F.lit(day)).otherwise(F.date_add(F.lit(day), (F.col("id") % 300).cast("int"))).alias("order_date"),
        (F.col("id") % 97).cast("double").alias("sales"),
        F.sha2(F.col("id").cast("string"), 256).alias("note"),
    )


def test_a_hot_order_is_split_in_the_join_back(spark):
    with conf(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50000",
    ):
        lines = hot_lines(spark).repartition(8)
        for op in (features.add_customer_features, features.add_order_features):
            result = op(lines)
            assert len(result.collect()) == 40000
            assert "skew=true" in plan_of(result)


def test_a_hot_order_is_split_when_the_tables_are_joined_again(spark):
    with conf(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50000",
    ):
        items = hot_lines(spark).select("order_id", F.lit("p").alias("product_id"), "sales", "note").repartition(8)
        orders = normalize.first_per_key(hot_lines(spark), ["order_id", "customer_id", "order_date"], ["order_date"])
        joined = join_per_key(items, orders, ["order_id"])
        assert len(joined.collect()) == 40000 and "skew=true" in plan_of(joined)


def test_totals_of_a_hot_order_are_whole(spark):
    got = features.add_order_features(hot_lines(spark)).where("order_id = 0").select("order_total_sales").distinct().collect()
    expected = sum((i % 97) for i in range(0, 40000, 2))
    assert [r[0] for r in got] == [float(expected)]


def test_first_rows_are_limited_before_the_shuffle(spark):
    first = normalize.first_per_key(hot_lines(spark), ["customer_id", "order_id"], ["order_date"])
    plan = plan_of(first)
    assert plan.count("WindowGroupLimit") >= 2 and first.count() == 26


def test_filters_and_columns_reach_the_scan(spark, small):
    plan = plan_of(QUERIES["category_sales"](spark, small))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    line = next(s for s in schemas if "l_" in s)
    assert {c.split(":")[0] for c in line.split(",")} == {"l_partkey", "l_extendedprice", "l_discount"}
    assert "orders" not in plan and "customer" not in plan


@pytest.mark.parametrize("name", ["association_rules", "baskets", "item_counts", "pair_counts", "recommendation_lists", "recommendations", "rule_evidence"])
def test_baskets_do_not_join_the_headers(spark, small, name):
    plan = plan_of(QUERIES[name](spark, small))
    assert "l_orderkey" in plan and "o_orderkey" not in plan and "orders.parquet" not in plan


def test_top_rules_neither_broadcast_nor_sort_all_names(spark):
    names = spark.range(1000).select(F.concat(F.lit("i"), "id").alias("item"), F.concat(F.lit("name "), "id").alias("product_name"))
    rules = spark.createDataFrame([("i1", "i2", 2.0), ("i3", "none", 1.5)], "product_a string, product_b string, lift double")
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        top = baskets.top_rules(rules, names)
        assert sorted(tuple(r)[:2] for r in top.collect()) == [("name 1", "name 2"), ("name 3", None)]
        assert "SortMergeJoin" not in plan_of(top)


def test_ids_do_not_depend_on_the_number_of_buckets(spark, small):
    items = normalize.order_items(cleaning.clean(dirty(spark, small)))
    found = [sorted(map(tuple, normalize.number_items(items, digits).collect()), key=repr) for digits in (2, 4, 5)]
    assert found[0] == found[1] == found[2]


def test_quantile_rounds_end_on_single_values(spark):
    draw = random.Random(5)
    table = [("m", -k / 7 if k % 997 == 0 else round(math.exp(draw.random() * 27 - 4), 2), 1) for k in range(20000)]
    values = spark.createDataFrame(table, "metric string, value double, cnt long")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    found = {r["prob"]: r["quantile"] for r in quantiles.exact_quantiles(values, ["metric"], probs).collect()}
    expected = values.agg(F.percentile("value", F.array(*map(F.lit, probs)))).first()[0]
    assert [found[p] for p in probs] == pytest.approx(expected, rel=1e-12)


def test_order_codes_keep_the_order_of_doubles(spark):
    numbers = [0.0, math.inf, 5e-324, 1e-310, 2.2250738585072014e-308, 1e-5, 0.1, 0.5, 0.9999999999999999, 1.0, 1.0000000000000002, 2.0, 3.5, 4.0, 1e15, 2.0**62, 1.7976931348623157e308]
    numbers = sorted({s * n for n in numbers for s in (-1, 1)})
    coded = quantiles.with_order_code(spark.createDataFrame([(n,) for n in numbers], "value double"))
    codes = [r["code"] for r in coded.orderBy("value").collect()]
    assert all(a < b for a, b in zip(codes, codes[1:]))
    assert codes[len(codes) // 2 + 1] == 1 and struct.unpack("<q", struct.pack("<d", numbers[-1]))[0] == codes[-1]


def test_infinite_values_do_not_end_a_search(spark):
    inf = math.inf
    for values in ([1.0, 2.0, inf], [-inf, 1.0, 2.0, 5.0, inf], [inf, inf, 1.0], [-0.0, 0.0, -inf, 5e-324]):
        frame = spark.createDataFrame([(v,) for v in values], "sales double")
        found = quantiles.exact_quantiles(quantiles.value_counts(quantiles.unpivot_numbers(frame, ["sales"]), ["metric"]), ["metric"], [0.25, 0.5, 0.75])
        expected = frame.agg(F.percentile("sales", F.array(*map(F.lit, [0.25, 0.5, 0.75])))).first()[0]
        assert [r["quantile"] for r in found.orderBy("prob").collect()] == expected


def test_a_text_infinity_in_a_raw_file_reaches_the_reports(spark):
    text = spark.createDataFrame([(str(v), "1") for v in ("Infinity", 1.0, 2.0, 3.0, 4.0)], "sales string, quantity string")
    typed = cleaning.convert_types(text)
    fence = cleaning.iqr_fences(typed, ["sales"]).first()
    assert (fence["q1"], fence["q3"], fence["outliers"]) == (2.0, 4.0, 1)
    row = statistics.describe(typed, ["sales"]).first()
    assert (row["count"], row["p50"], row["max"]) == (5, 3.0, math.inf)
    box = statistics.box_summary(typed, ["sales"]).first()
    assert (box["whisker_high"], box["outliers"]) == (4.0, 1)
