"""Small states that stand for many rows: quantiles and distinct counts within a stated error, merged without a rescan.

A state is kept per group, such as a month and a region. Coarser groups are merged from the states alone, so figures of a year
or of everything read one row per state and not the lines. The exact operators stay the default; these are
for tables too large to be read again for every figure.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerline.operators.quantiles import unpivot_numbers

#: Size of a quantile sketch: items at its top level.
QUANTILE_SIZE = 1024

#: Size of a distinct sketch: base-2 logarithm of its registers.
DISTINCT_SIZE = 14


def rank_error(size: int = QUANTILE_SIZE) -> float:
    """How far the rank of an estimated quantile lies from the asked one, as a share of the rows, in 99 of 100 cases.

    The published constants of the KLL sketch; merging does not add to the error.
    """
    return 2.296 / size**0.9723


def distinct_error(size: int = DISTINCT_SIZE) -> float:
    """Standard error of an estimated distinct count, as a share of it; three of them hold 99.7 of 100 estimates."""
    return 1.04 / 2 ** (size / 2)


def quantile_states(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), size: int = QUANTILE_SIZE) -> DataFrame:
    """(keys, metric, rows, state): one sketch of each column per group. Missing values are left out."""
    values = unpivot_numbers(df, columns, keys)
    return values.groupBy(*keys, "metric").agg(F.count("*").alias("rows"), F.kll_sketch_agg_double("value", size).alias("state"))


def merge_quantile_states(states: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The states of coarser groups, or of everything."""
    return states.groupBy(*keys, "metric").agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("state").alias("state"))


def quantiles_of(states: DataFrame, probs: Sequence[float]) -> DataFrame:
    """One row per state and probability: the value whose rank is about ``prob`` (see ``rank_error``)."""
    wanted = F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double("state", F.lit(float(p))).alias("quantile")) for p in probs])
    kept = [c for c in states.columns if c != "state"]
    return states.select(*kept, F.inline(wanted))


def rank_checks(df: DataFrame, found: DataFrame, columns: Sequence[str], size: int = QUANTILE_SIZE) -> DataFrame:
    """(metric, prob, rows, within): whether an estimate's exact rank lies within twice the stated error.

    The rank of a value that occurs often is a range. One pass over the lines; ``found`` has a row per column and probability.
    """
    values = unpivot_numbers(df, columns)
    ranked = values.join(F.broadcast(found.select("metric", "prob", "quantile")), "metric").groupBy("metric", "prob").agg(
        F.count("*").alias("rows"), F.count_if(F.col("value") < F.col("quantile")).alias("below"), F.count_if(F.col("value") <= F.col("quantile")).alias("upto")
    )
    slack = F.lit(2 * rank_error(size)) * F.col("rows")
    rank = F.col("prob") * F.col("rows")
    return ranked.select("metric", "prob", "rows", ((F.col("below") - slack <= rank) & (rank <= F.col("upto") + slack)).alias("within"))


def distinct_states(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), size: int = DISTINCT_SIZE) -> DataFrame:
    """(keys, one sketch column per named column): the distinct values of each group, from one pass over the lines."""
    typed = df.select(*keys, *[F.col(c).cast("string").alias(c) for c in columns])
    return typed.groupBy(*keys).agg(*[F.hll_sketch_agg(c, size).alias(c) for c in columns])


def distinct_estimates(states: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Estimated distinct counts of coarser groups, or of everything, from the states alone (see ``distinct_error``)."""
    merged = states.groupBy(*keys).agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns])
    return merged


def distinct_checks(df: DataFrame, states: DataFrame, columns: Sequence[str], keys: Sequence[str], scope: str, size: int = DISTINCT_SIZE) -> DataFrame:
    """(scope, name, metric, distinct_values, within): exact counts, and whether the estimates lie within three errors."""
    name = F.concat_ws("/", *[F.col(k).cast("string") for k in keys]) if keys else F.lit("all")
    exact = df.groupBy(*keys).agg(*[F.countDistinct(c).alias(f"exact_{c}") for c in columns])
    estimates = distinct_estimates(states, columns, keys)
    both = exact.join(estimates, list(keys)) if keys else exact.withColumns({c: estimates.select(c).scalar() for c in columns})
    cells = [
        F.struct(
            F.lit(c).alias("metric"), F.col(f"exact_{c}").alias("distinct_values"),
            (F.abs(F.col(c) - F.col(f"exact_{c}")) <= F.ceil(F.lit(3 * distinct_error(size)) * F.col(f"exact_{c}"))).alias("within"),
        )
        for c in columns
    ]
    return both.select(F.lit(scope).alias("scope"), name.alias("name"), F.inline(F.array(*cells)))
