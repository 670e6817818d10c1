from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from row_sets import rows

from ledgerline.operators import statistics


def numbers(spark, values, name="sales"):
    return spark.createDataFrame([(float(v),) for v in values], f"{name} double")


def test_histogram_puts_the_maximum_into_the_last_bin(spark):
    got = rows(statistics.histogram(numbers(spark, range(81)), ["sales"]), "bin", "row_count")
    expected = np.histogram(np.arange(81.0), bins=40)[0]
    assert [n for _, n in sorted(got)] == list(expected) and max(b for b, _ in got) == 39


def test_histogram_of_a_constant(spark):
    assert rows(statistics.histogram(numbers(spark, [3] * 5), ["sales"]), "bin", "row_count") == [(0, 5)]


def test_density_equals_a_direct_sum(spark):
    values = np.array([1.0, 1.0, 2.0, 4.0, 8.0])
    got = statistics.density(numbers(spark, values), ["sales"], points=9).orderBy("point").collect()
    h = values.std(ddof=1) * len(values) ** -0.2
    for r, x in zip(got, np.linspace(1, 8, 9), strict=True):
        direct = np.exp(-0.5 * ((x - values) / h) ** 2).sum() / (len(values) * h * np.sqrt(2 * np.pi))
        assert r["x"] == pytest.approx(x) and r["density"] == pytest.approx(direct)


def test_box_whiskers_end_on_data(spark):
    box = statistics.box_summary(numbers(spark, [1, 2, 3, 4, 5, 100]), ["sales"]).first()
    assert (box["whisker_low"], box["whisker_high"], box["outliers"]) == (1.0, 5.0, 1)
    assert (box["q1"], box["median"], box["q3"]) == (2.25, 3.5, 4.75)


def test_moments_are_of_the_population(spark):
    values = np.array([1.0, 2.0, 2.0, 3.0, 10.0])
    z = (values - values.mean()) / values.std()
    got = statistics.shape_moments(numbers(spark, values), ["sales"], digits=6).first()
    assert got["skewness"] == pytest.approx((z**3).mean(), abs=1e-6)
    assert got["kurtosis"] == pytest.approx((z**4).mean() - 3, abs=1e-6) and got["shape"] == "right-skewed"


def test_describe_and_correlation(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(0, 10, (50, 3)).round(2)
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], "sales double, profit double, quantity double")
    cols = ["sales", "profit", "quantity"]
    described = {r["metric"]: r for r in statistics.describe(df, cols, precount=False).collect()}
    assert described["profit"]["std"] == pytest.approx(data[:, 1].std(ddof=1), abs=0.006)
    assert described["quantity"]["p75"] == pytest.approx(np.quantile(data[:, 2], 0.75), abs=0.006)
    matrix = statistics.correlation_matrix(df, cols, digits=6)
    got = {r["metric"]: r for r in matrix.collect()}
    assert [got[a][b] for a in cols for b in cols] == pytest.approx(list(np.corrcoef(data.T).ravel()), abs=1e-6)
    extremes = {r["kind"]: r["metric"] for r in statistics.correlation_extremes(matrix).collect()}
    assert set(extremes.values()) == {"profit", "quantity"}


def test_sample_is_bounded_whole_and_repeatable(spark):
    df = spark.range(5000).selectExpr("id", "id % 7 AS v")
    sample = statistics.bounded_sample(df, ["id", "v"], ["id"], size=100)
    assert sample.count() == 100 and rows(sample) == rows(statistics.bounded_sample(df.repartition(5), ["id", "v"], ["id"], size=100))
    assert statistics.bounded_sample(df.limit(30), ["id"], ["id"], size=100).count() == 30


def test_binned_density_stays_within_its_bound(spark):
    k = F.col("id")
    noise = F.pmod(F.xxhash64(k), F.lit(1 << 30)) / float(1 << 30)
    frame = spark.range(4000).select((F.exp(noise * 4) + k % 2 * 30).alias("sales"), F.when(k % 3 == 0, 5.0).otherwise(noise).alias("profit"), F.lit(1.0).alias("quantity"))
    for fineness in (2, 16):
        exact = {(r["metric"], r["point"]): r for r in statistics.density(frame, ["sales", "profit", "quantity"]).collect()}
        found = statistics.binned_density(frame, ["sales", "profit", "quantity"], fineness=fineness).collect()
        assert {(r["metric"], r["point"]) for r in found} == set(exact) and len(found) == 400
        off = [abs(r["density"] - exact[r["metric"], r["point"]]["density"]) / r["error_bound"] for r in found]
        assert 0 < max(off) <= 1 and all(abs(r["x"] - exact[r["metric"], r["point"]]["x"]) < 1e-9 for r in found)
