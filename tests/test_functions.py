from __future__ import annotations

import datetime as dt

import numpy as np
import pytest

from ledgerline.functions import calendar as cal, keys, labels
from ledgerline.functions.numbers import half_even, ratio


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], schema).select(column).first()[0]


@pytest.mark.parametrize("value, digits", [(0.125, 2), (0.145, 2), (2.675, 2), (-0.125, 2), (1234.5, 0), (0.00125, 4)])
def test_half_even_matches_numpy(spark, value, digits):
    assert one(spark, half_even("x", digits), x=("double", value)) == np.round(value, digits)


def test_half_even_matches_numpy_on_many_values(spark):
    values = np.random.default_rng(7).normal(0, 1e4, 2000)
    got = [r[0] for r in spark.createDataFrame([(float(v),) for v in values], "x double").select(half_even("x", 2)).collect()]
    assert got == list(np.round(values, 2))


def test_ratio_by_zero_is_null(spark):
    assert one(spark, ratio("x", "y"), x=("double", 1.0), y=("int", 0)) is None


@pytest.mark.parametrize(
    "day, sunday",
    [((2022, 1, 1), (2022, 1, 2)), ((2022, 1, 2), (2022, 1, 2)), ((2022, 1, 3), (2022, 1, 9))],
)
def test_week_is_labelled_by_its_sunday(spark, day, sunday):
    assert one(spark, cal.week_end("d"), d=("date", dt.date(*day))) == dt.date(*sunday)


def test_calendar_columns(spark):
    day = ("date", dt.date(2024, 10, 5))
    assert one(spark, cal.weekday_name("d"), d=day) == "Saturday"
    assert one(spark, cal.is_weekend("d"), d=day) is True
    assert one(spark, cal.is_festive("d"), d=day) is True
    assert one(spark, cal.month_label("d"), d=day) == "2024-10"
    assert one(spark, cal.month_label("d", long=True), d=day) == "October 2024"


@pytest.mark.parametrize("month, weight", [(1, 1.3), (2, 1.0), (10, 1.6), (11, 1.6), (12, 1.2)])
def test_seasonal_weight(spark, month, weight):
    assert float(one(spark, cal.seasonal_weight("d"), d=("date", dt.date(2023, month, 15)))) == weight


@pytest.mark.parametrize(
    "rate, bucket",
    [(0.0, 0), (0.1, 1), (0.2, 1), (0.21, 2), (0.35, 2), (0.36, 3), (None, 3)],
)
def test_discount_bucket(spark, rate, bucket):
    assert one(spark, labels.discount_bucket("x"), x=("double", rate)) == labels.DISCOUNT_BUCKETS[bucket]


@pytest.mark.parametrize("total, size", [(1999.99, 0), (2000.0, 1), (14999.99, 1), (15000.0, 2), (None, 2)])
def test_order_size(spark, total, size):
    assert one(spark, labels.order_size("x"), x=("double", total)) == labels.ORDER_SIZES[size]


@pytest.mark.parametrize("skew, label", [(0.51, "right-skewed"), (-0.51, "left-skewed"), (0.5, "roughly symmetric")])
def test_skew_label(spark, skew, label):
    assert one(spark, labels.skew_label("x"), x=("double", skew)) == label


@pytest.mark.parametrize("rate, label", [(50.1, "strong"), (50.0, "moderate"), (25.0, "weak")])
def test_retention_label(spark, rate, label):
    assert one(spark, labels.retention_label("x"), x=("double", rate)) == label


def test_business_keys_keep_long_numbers(spark):
    assert one(spark, keys.business_key("n", keys.CUSTOMER_KEY), n=("bigint", 7)) == "CUST-00007"
    assert one(spark, keys.business_key("n", keys.CUSTOMER_KEY), n=("bigint", 1234567)) == "CUST-1234567"


@pytest.mark.parametrize("noun, name", [("Chairs", "Eco Chair"), ("Art", "Eco Art"), ("Accessories", "Eco Accessorie")])
def test_display_name(spark, noun, name):
    assert one(spark, keys.display_name("a", "n"), a=("string", "Eco"), n=("string", noun)) == name
