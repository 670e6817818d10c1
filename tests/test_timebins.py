from __future__ import annotations

import datetime as dt

from row_sets import rows

from ledgerline.operators import kpis, timebins

# Published monthly sales, January 2022 on, and the growth they imply.
MONTHLY_SALES = [
    10499088.35, 6816589.54, 10780330.43, 7235921.06, 8645453.49, 12602527.85, 7651323.48, 8387005.72, 7864237.16,
    16255643.74, 17607393.49, 11206138.96, 10717573.09, 7384777.65, 9112435.65, 8946241.39, 7372479.98, 8089966.54,
    7733677.94, 9937715.93, 7045565.93, 13320499.31, 13019375.25, 13009023.7, 11064995.29, 8132555.69, 9607815.47,
    9650124.63, 9569067.34, 10149898.38, 7919765.25, 8075238.6, 9938917.76, 11432829.06, 12353351.47, 9947860.93,
    9706214.23, 9716105.79, 9679801.07, 8017686.78, 10945604.15, 9896862.53, 9309250.68, 7932977.46, 11597829.89,
    19112700.36, 14460995.97, 12559160.15,
]
MONTHLY_GROWTH = [
    None, -35.07, 58.15, -32.88, 19.48, 45.77, -39.29, 9.62, -6.23, 106.7, 8.32, -36.36, -4.36, -31.1, 23.39, -1.82,
    -17.59, 9.73, -4.4, 28.5, -29.1, 89.06, -2.26, -0.08, -14.94, -26.5, 18.14, 0.44, -0.84, 6.07, -21.97, 1.96, 23.08,
    15.03, 8.05, -19.47, -2.43, 0.1, -0.37, -17.17, 36.52, -9.58, -5.94, -14.78, 46.2, 64.8, -24.34, -13.15,
]


def orders(spark, data):
    return spark.createDataFrame(
        [(dt.date(*d), i, s, s / 10) for i, (d, s) in enumerate(data)],
        "order_date date, order_id int, sales double, profit double",
    )


def test_published_growth_follows_from_published_sales(spark):
    data = [((2022 + i // 12, i % 12 + 1, 15), s) for i, s in enumerate(MONTHLY_SALES)]
    trend = timebins.monthly_trend(orders(spark, data)).orderBy("order_date").collect()
    assert [r["mom_growth_pct"] for r in trend] == MONTHLY_GROWTH
    assert trend[1]["order_date"] == dt.date(2022, 2, 28)


def test_an_empty_month_is_zero_and_growth_after_it_is_unknown(spark):
    df = orders(spark, [((2023, 1, 31), 100.0), ((2023, 3, 1), 50.0), ((2023, 4, 30), 75.0)])
    assert rows(timebins.monthly_trend(df), "order_date", "total_sales", "order_count", "mom_growth_pct") == sorted(
        [
            (dt.date(2023, 1, 31), 100.0, 1, None),
            (dt.date(2023, 2, 28), 0.0, 0, -100.0),
            (dt.date(2023, 3, 31), 50.0, 1, None),
            (dt.date(2023, 4, 30), 75.0, 1, 50.0),
        ],
        key=repr,
    )


def test_months_of_different_length_are_not_skipped(spark):
    df = orders(spark, [((2023, 1, 31), 1.0), ((2024, 1, 31), 1.0)])
    assert timebins.monthly_trend(df).count() == 13


def test_weeks_are_filled_and_indexed(spark):
    df = orders(spark, [((2022, 1, 1), 1.0), ((2022, 1, 2), 2.0), ((2022, 1, 17), 4.0)])
    weekly = timebins.add_week_features(timebins.weekly_sales(df))
    assert rows(weekly, "week_end", "total_sales", "time_index", "week_of_year") == sorted(
        [
            (dt.date(2022, 1, 2), 3.0, 0, 52), (dt.date(2022, 1, 9), 0.0, 1, 1),
            (dt.date(2022, 1, 16), 0.0, 2, 2), (dt.date(2022, 1, 23), 4.0, 3, 3),
        ],
        key=repr,
    )


def test_split_keeps_the_last_weeks_for_testing(spark):
    first = dt.date(2022, 1, 2)
    df = spark.createDataFrame([(first + dt.timedelta(7 * i), 1.0) for i in range(210)], "week_end date, total_sales double")
    split = timebins.chronological_split(timebins.add_week_features(df))
    assert rows(timebins.split_bounds(split)) == [
        (False, dt.date(2025, 6, 1), dt.date(2026, 1, 4), 32), (True, dt.date(2022, 1, 2), dt.date(2025, 5, 25), 178),
    ]


def test_peak_and_low_take_the_earliest_on_a_tie(spark):
    df = orders(spark, [((2023, 1, 5), 9.0), ((2023, 2, 5), 1.0), ((2023, 3, 5), 9.0), ((2023, 4, 5), 1.0)])
    assert rows(timebins.peak_and_low(timebins.monthly_trend(df)), "kind", "month") == [("low", "2023-02"), ("peak", "2023-01")]


def test_heatmap_zero_for_an_empty_cell_null_for_an_absent_month(spark):
    df = spark.createDataFrame(
        [("a", dt.date(2023, 1, 1), 5.0), ("b", dt.date(2023, 2, 1), 7.0)], "category string, order_date date, sales double"
    )
    got = {r["category"]: r for r in kpis.sales_heatmap(df).collect()}
    assert (got["a"]["Jan"], got["a"]["Feb"], got["a"]["Mar"]) == (5.0, 0.0, None)
    assert (got["b"]["Jan"], got["b"]["Feb"]) == (0.0, 7.0)


def test_regional_share_is_of_everything(spark):
    df = spark.createDataFrame(
        [("n", 1, 30.0, 1.0), ("s", 2, 60.0, 1.0), (None, 3, 10.0, 1.0)], "region string, order_id int, sales double, profit double"
    )
    assert rows(kpis.regional(df), "region", "sales_share_pct") == [("n", 30.0), ("s", 60.0)]


def test_headline_counts_orders_not_lines(spark):
    df = spark.createDataFrame(
        [(1, 1, 10.0, 1.0), (1, 1, 20.0, 1.0), (1, 2, 30.0, 1.0), (2, 3, 40.0, 1.0)],
        "customer_id int, order_id int, sales double, profit double",
    )
    got = kpis.headline(df).first()
    assert (got["total_orders"], got["total_customers"], got["repeat_customers"]) == (3, 2, 1)
    assert got["average_order_value"] == 100.0 / 3 and got["customer_lifetime_value"] == 50.0
    assert got["repeat_customer_rate_pct"] == 50.0 and got["retention"] == "moderate"
