from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerline.operators.quantiles import exact_quantiles, unpivot_numbers, value_counts

PROBS = [0.25, 0.5, 0.75]


def quantiles(spark, values, precount=True):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    long = unpivot_numbers(df, ["x"])
    long = value_counts(long, ["metric"]) if precount else long.withColumn("cnt", F.lit(1).cast("long"))
    found = exact_quantiles(long, ["metric"], PROBS).collect()
    return {r["prob"]: r["quantile"] for r in found}


@pytest.mark.parametrize("precount", [True, False])
@pytest.mark.parametrize(
    "values",
    [
        [5.0],
        [1.0, 2.0],
        [3.0] * 10,
        list(range(100)),
        [0.0] * 70 + [1e12] + list(np.linspace(0, 1, 30)),  # a far outlier squeezes all values into one bin
        [-5.5, -5.5, 0.25, 0.25, 9.75, 1e-9],
    ],
)
def test_equal_to_numpy(spark, values, precount):
    got = quantiles(spark, values, precount=precount)
    for p in PROBS:
        assert got[p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6).map(lambda v: round(v, 2)), min_size=1, max_size=60))
def test_equal_to_numpy_on_any_list(spark, values):
    got = quantiles(spark, values)
    for p in PROBS:
        assert got[p] == pytest.approx(np.quantile(values, p), rel=1e-9, abs=1e-9)


def test_one_value_holding_a_third_of_the_rows(spark):
    values = [7.0] * 400 + list(np.random.default_rng(1).normal(0, 100, 800).round(2))
    got = quantiles(spark, values)
    for p in PROBS:
        assert got[p] == pytest.approx(np.quantile(values, p))


def test_groups_are_separate(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(11)] + [("b", float(i * 10)) for i in range(5)], "g string, x double")
    counted = value_counts(unpivot_numbers(df, ["x"], ["g"]), ["g", "metric"])
    got = {(r["g"], r["prob"]): r["quantile"] for r in exact_quantiles(counted, ["g", "metric"], PROBS).collect()}
    assert got[("a", 0.5)] == 5.0 and got[("b", 0.25)] == 10.0 and got[("b", 0.75)] == 30.0


def test_missing_values_are_ignored(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (float("nan"),)], "x double")
    counted = value_counts(unpivot_numbers(df, ["x"], keep_missing=True), ["metric"])
    got = {r["prob"]: r["quantile"] for r in exact_quantiles(counted, ["metric"], PROBS).collect()}
    assert got[0.5] == 2.0
