from __future__ import annotations

import datetime as dt

from row_sets import rows
from hypothesis import HealthCheck, given, settings, strategies as st

from ledgerline.operators import cleaning

DAY = dt.date(2024, 3, 10)


def amounts(spark, data):
    return spark.createDataFrame(
        [(DAY, DAY, s, q) for s, q in data], "order_date date, ship_date date, sales double, quantity int"
    )


def test_unknown_sales_stay_and_unknown_quantities_go(spark):
    df = amounts(spark, [(1.0, 1), (None, 1), (-1.0, 1), (0.0, 1), (1.0, None), (1.0, 0), (1.0, -2)])
    assert rows(cleaning.drop_invalid_amounts(df), "sales", "quantity") == [(1.0, 1), (None, 1)]


def test_violations_name_only_broken_rules(spark):
    df = amounts(spark, [(1.0, 1), (-1.0, 0), (0.0, 1), (5.0, -1)])
    # The line with bad sales is already gone when quantities are judged.
    assert rows(cleaning.rule_violations(df)) == [("quantity <= 0", 1), ("sales <= 0", 2)]


def test_ship_date_is_repaired(spark):
    df = spark.createDataFrame(
        [(DAY, DAY - dt.timedelta(1)), (DAY, DAY), (DAY, None)], "order_date date, ship_date date"
    )
    assert rows(cleaning.repair_ship_dates(df), "ship_date") == sorted([(DAY + dt.timedelta(1),), (DAY,), (None,)], key=repr)


def test_values_that_do_not_parse_become_null(spark):
    text = spark.createDataFrame(
        [("2024-02-30", "x", "1.5", "1"), ("2024-02-29", "2.5", "3", "2"), (None, None, "3.0", None)],
        "order_date string, sales string, quantity string, order_id string",
    )
    typed = cleaning.convert_types(text)
    assert rows(typed, "order_date", "sales", "quantity", "order_id") == sorted(
        [(None, None, None, "1"), (dt.date(2024, 2, 29), 2.5, 3, "2"), (None, None, 3, None)], key=repr
    )
    audit = rows(cleaning.conversion_audit(text, typed))
    assert ("quantity", "string", "int") in audit and all(name != "order_id" for name, *_ in audit)


def test_copies_with_nulls_collapse(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a")], "a int, b string")
    assert rows(cleaning.remove_copies(df)) == [(1, "a"), (1, None)]


def test_fill_and_its_record(spark):
    df = spark.createDataFrame([(None, None), ("Ann", 0.1), (None, 0.2)], "customer_name string, discount double")
    assert rows(cleaning.fill_missing(df)) == [("Ann", 0.1), ("Guest Customer", 0.0), ("Guest Customer", 0.2)]
    assert rows(cleaning.fill_decisions(df)) == [("customer_name", 2, "Guest Customer"), ("discount", 1, "0.0")]
    assert rows(cleaning.null_profile(df)) == [("customer_name", 2), ("discount", 1)]
    partial = df.select("discount")
    assert cleaning.fill_missing(partial).columns == ["discount"]


def test_shape_audit_counts_every_step(spark):
    data = [(1, DAY, DAY, 5.0, 1)] * 3 + [(2, DAY, DAY, -1.0, 1), (3, DAY, DAY, None, 2)]
    df = spark.createDataFrame(data, "order_id int, order_date date, ship_date date, sales double, quantity int")
    assert cleaning.shape_audit(df).first().asDict() == {
        "rows_before": 5, "columns_before": 5, "copies_removed": 2, "rows_after": 2, "columns_after": 5,
    }
    assert cleaning.clean(df).count() == 2


def test_outlier_share_is_of_all_rows(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 1000]] + [(None,)], "sales double")
    fence = cleaning.iqr_fences(df, ["sales"]).first()
    assert (fence["q1"], fence["q3"], fence["outliers"], fence["outlier_pct"]) == (2.0, 4.0, 1, 16.67)
    flags = rows(cleaning.outlier_flags(df, ["sales"]), "sales", "is_sales_outlier")
    assert (1000.0, True) in flags and (None, False) in flags and (4.0, False) in flags


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", None])), min_size=1, max_size=30))
def test_removing_copies_twice_changes_nothing(spark, data):
    once = cleaning.remove_copies(spark.createDataFrame(data, "a int, b string"))
    assert rows(cleaning.remove_copies(once)) == rows(once)
    assert once.count() == len(set(data))


def test_category_profile_lists_frequent_values_exactly(spark):
    few = [("a",)] * 5 + [("b",)] * 3 + [("c",)] * 3 + [(None,)] * 4
    listed = rows(cleaning.category_profile(spark.createDataFrame(few, "region string"), ["region"], top=2))
    assert listed == [("region", 1, "a", 5, 45.45, False), ("region", 2, "b", 3, 27.27, False)]
    assert {r["is_complete"] for r in cleaning.category_profile(spark.createDataFrame(few, "region string"), ["region"], top=3).collect()} == {True}
    # 30,000 different values beside three frequent ones, and at most 64 values tracked
    many = spark.range(60_000).selectExpr("CASE WHEN id % 10 < 2 THEN 'x' WHEN id % 10 = 2 THEN 'y' WHEN id % 10 = 3 THEN 'z' ELSE string(id) END AS region", "id AS city")
    found = cleaning.category_profile(many, ["region", "city"], top=3, tracked=64)
    assert rows(found.where("column_name = 'region'"), "value", "row_count") == [("x", 12_000), ("y", 6_000), ("z", 6_000)]
    assert {r["is_complete"] for r in found.collect()} == {False} and found.where("column_name = 'city' AND row_count > 1").isEmpty()
    assert cleaning.category_profile(many.limit(0), ["region"]).collect() == []


def test_figures_of_counted_copies_are_those_of_the_rows(spark, small):
    from ledgerline.registry import queries

    raw = queries.dirty(spark, small)
    counted = cleaning.counted_copies(cleaning.fill_missing(raw))
    assert cleaning.shape_of_counted(counted).collect() == cleaning.shape_audit(raw).collect()
    assert counted.count() == cleaning.remove_copies(cleaning.fill_missing(raw)).count() < raw.count()


def test_reports_read_stored_frames(spark, small):
    """Joined lines are computed once, not by every section of a report."""
    from ledgerline.registry import queries

    plan = queries.eda_report(spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_extendedprice" not in plan and "/table-" in queries.eda_report(spark, small)._jdf.queryExecution().executedPlan().toString()
