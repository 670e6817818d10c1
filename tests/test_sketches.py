"""Estimates from merged states against exact figures."""

from __future__ import annotations

import math

import pytest
from row_sets import rows
from pyspark.sql import functions as F

from ledgerline.operators import sketches


@pytest.fixture(scope="module")
def numbers(spark):
    """A skewed column, one with a value that half of the rows share, and one with missing values, in 30 groups."""
    k = F.col("id")
    noise = F.pmod(F.xxhash64(k), F.lit(1 << 30)) / float(1 << 30)
    return spark.range(60_000, numPartitions=8).select(
        (k % 30).alias("day"), (k % 3).alias("shop"), F.exp(noise * 12).alias("skewed"), F.when(k % 2 == 0, 7.0).otherwise(noise).alias("lumpy"),
        F.when(k % 5 == 0, None).when(k % 5 == 1, float("nan")).otherwise(noise).alias("gaps"), F.pmod(F.xxhash64(k), F.lit(9000)).alias("who"),
    ).cache()


def test_ranks_of_merged_sketches_are_within_the_error(numbers):
    columns = ["skewed", "lumpy", "gaps"]
    states = sketches.quantile_states(numbers, columns, ["day"])
    found = sketches.quantiles_of(sketches.merge_quantile_states(states), [0.01, 0.25, 0.5, 0.75, 0.99])
    checked = sketches.rank_checks(numbers, found, columns).collect()
    assert len(checked) == 15 and all(r["within"] for r in checked)
    assert {(r["metric"], r["rows"]) for r in checked} == {("skewed", 60_000), ("lumpy", 60_000), ("gaps", 36_000)}
    assert found.where("metric = 'lumpy' AND prob = 0.75").first()["quantile"] == 7.0


def test_a_wrong_quantile_is_seen(numbers):
    found = sketches.quantiles_of(sketches.quantile_states(numbers, ["skewed"]), [0.5])
    off = found.withColumn("quantile", F.exp(F.lit(12 * 0.52)))
    assert sketches.rank_checks(numbers, off, ["skewed"]).first()["within"] is False


def test_errors_shrink_with_the_size():
    assert sketches.rank_error(200) == pytest.approx(0.0133, abs=1e-4) and sketches.rank_error(4096) < sketches.rank_error(1024) < 0.003
    assert sketches.distinct_error(14) == pytest.approx(0.0081, abs=1e-4)


def test_states_of_one_group_and_of_no_rows(spark, numbers):
    few = numbers.where("day = 3").limit(3)
    assert rows(sketches.quantiles_of(sketches.quantile_states(few, ["skewed"]), [1.0]), "rows", "quantile") == [(3, few.agg(F.max("skewed")).first()[0])]
    assert sketches.quantile_states(numbers.limit(0), ["skewed"]).collect() == []
    assert sketches.distinct_estimates(sketches.distinct_states(numbers.limit(0), ["who"], ["day"]), ["who"]).first()["who"] in (0, None)


def test_distinct_counts_of_merged_states(numbers):
    states = sketches.distinct_states(numbers, ["who"], ["day", "shop"])
    whole = sketches.distinct_estimates(states, ["who"]).first()["who"]
    exact = numbers.select(F.countDistinct("who")).first()[0]
    assert math.fabs(whole - exact) <= 3 * sketches.distinct_error() * exact
    for keys in ([], ["day"], ["shop"]):
        checked = sketches.distinct_checks(numbers, states, ["who"], keys, "s").collect()
        assert checked and all(r["within"] for r in checked)
    assert {r["name"] for r in sketches.distinct_checks(numbers, states, ["who"], ["shop"], "s").collect()} == {"0", "1", "2"}
