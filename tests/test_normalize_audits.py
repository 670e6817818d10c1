from __future__ import annotations

import datetime as dt

from row_sets import rows

from ledgerline.operators import audits, normalize
from ledgerline.schemas import ORDER_LINE_COLUMNS

DAY = dt.date(2024, 1, 1)


def line(order, product, customer="c1", name="Ann", day=DAY, sales=10.0, discount=0.1):
    return (order, day, day, "Air", customer, name, "Home", "X", "Y", "Z", "N", product, "Cat", "Sub", f"P {product}",
            sales, 1, discount, 1.0)


def lines(spark, data):
    types = {"order_date": "date", "ship_date": "date", "sales": "double", "quantity": "int", "discount": "double", "profit": "double"}
    return spark.createDataFrame(data, ", ".join(f"{c} {types.get(c, 'string')}" for c in ORDER_LINE_COLUMNS))


def test_dimensions_take_the_first_row(spark):
    df = lines(spark, [
        line("o2", "p1", name="Ann", day=DAY + dt.timedelta(1)), line("o1", "p2", name="Guest Customer"), line("o3", "p1", "c2", "Bo"),
    ])
    assert rows(normalize.customers(df), "customer_id", "customer_name") == [("c1", "Guest Customer"), ("c2", "Bo")]
    assert rows(normalize.customers_preferring_names(df), "customer_id", "customer_name") == [("c1", "Ann"), ("c2", "Bo")]
    assert normalize.products(df).count() == 2 and normalize.order_headers(df).count() == 3


def test_round_trip_through_the_tables(spark):
    df = lines(spark, [line("o1", "p1"), line("o1", "p2", sales=2.5, discount=None), line("o2", "p1", "c2", "Bo")])
    items = normalize.number_items(normalize.order_items(df))
    view = normalize.order_summary(items, normalize.order_headers(df), normalize.customers(df), normalize.products(df))
    assert len(view.columns) == 20 and view.count() == 3
    assert rows(view, "order_id", "product_id", "customer_name") == rows(df, "order_id", "product_id", "customer_name")
    assert [float(r[0]) for r in view.where("sales = 2.5").select("discount").collect()] == [0.0]


def test_numbers_are_dense_and_repeatable_with_a_hot_order(spark):
    data = [line("hot" if i % 3 else f"o{i}", f"p{i}", sales=float(i + 1)) for i in range(300)]
    items = normalize.order_items(lines(spark, data))
    first = normalize.number_items(items, digits=2)
    assert sorted(r[0] for r in first.select("order_item_id").collect()) == list(range(1, 301))
    again = normalize.number_items(items.repartition(7), digits=2)
    assert rows(first) == rows(again)


def test_audits_find_one_violation_each(spark):
    parents = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    children = spark.createDataFrame([(1,), (3,), (3,), (None,)], "fk int")
    assert rows(audits.primary_key_audit({"parents": (parents, ["k"])})) == [("parents", "k", 1, 1)]
    assert rows(audits.foreign_key_audit([("children", children, "fk", "parents", parents, "k")])) == [
        ("children", "parents", "fk", 1, 2)
    ]
    assert rows(audits.not_null_audit(children, ["fk"])) == [("fk", 1)]
    checked = spark.createDataFrame(
        [(DAY, DAY - dt.timedelta(1), 1.0, 1, 0.1), (DAY, DAY, 0.0, 1, 1.5), (DAY, None, None, -1, None)],
        "order_date date, ship_date date, sales double, quantity int, discount double",
    )
    assert rows(audits.check_audit(checked)) == [
        ("discount between 0 and 1", 1), ("quantity > 0", 1), ("sales > 0", 1), ("ship_date >= order_date", 1),
    ]
    wide = spark.createDataFrame([("x" * 21, 1e11), ("y", 1.0), (None, None)], "order_id string, sales double")
    assert rows(audits.length_audit(wide)) == [("order_id", 1), ("sales", 1)]


def test_one_pass_over_a_table_finds_what_two_audits_find(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("x" * 300, 1.5, None), (None, 1e12, "a")], "customer_name string, sales double, segment string")
    apart = audits.not_null_audit(df, df.columns).select("column_name", F.lit("not null").alias("rule"), F.col("null_count").alias("broken_rows")).unionByName(
        audits.length_audit(df).select("column_name", F.lit("length").alias("rule"), F.col("oversized_values").alias("broken_rows"))
    )
    together = audits.table_audit(df)
    assert sorted(map(tuple, together.collect())) == sorted(map(tuple, apart.collect()))
    assert sum(r["broken_rows"] for r in together.collect()) >= 3
