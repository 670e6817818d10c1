"""Exploratory statistics: moments, quantiles, correlation, histograms, densities, box summaries, samples."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerline.functions.keys import row_digest
from ledgerline.functions.labels import skew_label
from ledgerline.functions.numbers import half_even, ratio
from ledgerline.operators.quantiles import (
    exact_quantiles, per_group, unpivot_numbers, value_counts, widen_quantiles,
)
from ledgerline.schemas import CHARTED_COLUMNS, DESCRIBED_COLUMNS

# Histogram bins, density grid, sample size, whisker length in interquartile ranges.
HISTOGRAM_BINS = 40
DENSITY_POINTS = 200
SAMPLE_ROWS = 2000
WHISKER = 1.5
#: Bandwidths beyond which the Gaussian kernel is exactly zero as a double.
KERNEL_REACH = 39.0
#: Bins of the binned density within a bandwidth, and bandwidths beyond which its kernel is left out (below 1e-17 of its peak).
BINS_PER_BANDWIDTH = 16
BINNED_REACH = 9.0


def _numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select([F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])


def _weighted_values(df: DataFrame, columns: Sequence[str], keys: Sequence[str], precount: bool) -> DataFrame:
    """(keys, metric, value, cnt): counted once per distinct value when the input is costly to compute
    again, or one row per value when it is a plain scan and a shuffle would cost more."""
    values = unpivot_numbers(df, columns, keys)
    if precount:
        return value_counts(values, [*keys, "metric"])
    return values.withColumn("cnt", F.lit(1).cast("long"))


def describe(
    df: DataFrame,
    columns: Sequence[str] = DESCRIBED_COLUMNS,
    precount: bool = True,
    digits: int | None = 2,
) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum, one row per column.

    ``digits=None`` leaves the figures unrounded.
    """

    def shown(c: str | Column, name: str) -> Column:
        column = F.col(c) if isinstance(c, str) else c
        return (column if digits is None else half_even(column, digits)).alias(name)

    wide = _numeric(df, columns).agg(
        *[
            F.struct(
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).alias("min"),
                F.max(c).alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    moments = wide.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("m")) for c in columns]))
    )
    values = _weighted_values(df, columns, [], precount)
    quartiles = widen_quantiles(
        exact_quantiles(values, ["metric"], [0.25, 0.5, 0.75]), ["metric"], {0.25: "p25", 0.5: "p50", 0.75: "p75"}
    )
    joined = moments.join(quartiles, "metric", "left")
    return joined.select(
        "metric",
        F.col("m.count").alias("count"),
        *[shown(f"m.{c}", c) for c in ("mean", "std", "min")],
        *[shown(c, c) for c in ("p25", "p50", "p75")],
        shown("m.max", "max"),
    )


def shape_moments(df: DataFrame, columns: Sequence[str] = DESCRIBED_COLUMNS, digits: int = 2) -> DataFrame:
    """Population skewness and excess kurtosis with the verbal reading of the skewness."""
    values = unpivot_numbers(df, columns)
    moments = values.groupBy("metric").agg(
        F.skewness("value").alias("skewness"), F.kurtosis("value").alias("kurtosis")
    )
    return moments.select(
        "metric",
        half_even("skewness", digits).alias("skewness"),
        half_even("kurtosis", digits).alias("kurtosis"),
        skew_label("skewness").alias("shape"),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str] = DESCRIBED_COLUMNS, digits: int = 2) -> DataFrame:
    """Pearson matrix in one pass: every unordered pair of columns is one group, then mirrored.

    Rows are fanned out to the pairs and aggregated at once in the same task. One aggregate per pair side
    by side would outgrow generated code.
    """
    pairs = list(combinations(columns, 2))
    cells = [part for a, b in pairs for part in (F.lit(a), F.lit(b), F.col(a), F.col(b))]
    fanned = _numeric(df, columns).select(F.stack(F.lit(len(pairs)), *cells).alias("a", "b", "x", "y"))
    values = fanned.groupBy("a", "b").agg(half_even(F.corr("x", "y"), digits).alias("value"))
    sides = F.array(
        F.struct(F.col("a").alias("metric"), F.col("b").alias("other"), "value"),
        F.struct(F.col("b").alias("metric"), F.col("a").alias("other"), "value"),
    )
    return (
        values.select(F.inline(sides))
        .groupBy("metric")
        .agg(*[F.max(F.when(F.col("other") == c, F.col("value"))).alias(c) for c in columns])
        .select("metric", *[F.when(F.col("metric") == c, F.lit(1.0)).otherwise(F.col(c)).alias(c) for c in columns])
    )


def correlation_extremes(matrix: DataFrame, target: str = "sales") -> DataFrame:
    """Highest and lowest signed correlation with the target; names break ties."""
    others = matrix.where(F.col("metric") != target).select("metric", F.col(target).alias("value"))
    wide = others.agg(
        F.min_by(F.struct("metric", "value"), F.struct(-F.col("value"), "metric")).alias("highest"),
        F.min_by(F.struct("metric", "value"), F.struct("value", "metric")).alias("lowest_signed"),
    )
    rows = [
        F.struct(F.lit(kind).alias("kind"), F.col(f"{kind}.metric").alias("metric"), F.col(f"{kind}.value").alias("value"))
        for kind in ("highest", "lowest_signed")
    ]
    return wide.select(F.inline(F.array(*rows)))


def histogram(
    df: DataFrame, columns: Sequence[str] = CHARTED_COLUMNS, bins: int = HISTOGRAM_BINS, precount: bool = True
) -> DataFrame:
    """Counts per equal-width bin between minimum and maximum; the maximum falls into the last bin."""
    values = _weighted_values(df, columns, [], precount)
    limits = values.groupBy("metric").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    position = F.when(width > 0, F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1)))
    # One row per listed column: a fixed size, safe to broadcast.
    return (
        values.join(F.broadcast(limits), "metric")
        .groupBy("metric", F.coalesce(position, F.lit(0)).cast("int").alias("bin"), "lo", width.alias("width"))
        .agg(F.sum("cnt").alias("row_count"))
        .select("metric", "bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"), "row_count")
    )


def density(df: DataFrame, columns: Sequence[str] = CHARTED_COLUMNS, points: int = DENSITY_POINTS) -> DataFrame:
    """Gaussian kernel density on an even grid from minimum to maximum, bandwidth by Scott's rule.

    Exact: evaluated per distinct value, weighted by its frequency. Amounts have two decimals, so the
    distinct values are far fewer than the rows of a large table, and every task sums its share into
    ``points`` cells per column before the shuffle. A value counts at the grid points that its kernel
    reaches; elsewhere the kernel is zero in double precision.
    """
    counted = _weighted_values(df, columns, [], precount=True)
    center = counted.groupBy("metric").agg(
        F.sum("cnt").alias("n"),
        (F.sum(F.col("value") * F.col("cnt")) / F.sum("cnt")).alias("mean"),
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
    )
    # One row per listed column: a fixed size, safe to broadcast.
    spread = counted.join(F.broadcast(center), "metric").groupBy("metric", "n", "lo", "hi").agg(
        F.sqrt(F.sum(F.col("cnt") * F.pow(F.col("value") - F.col("mean"), 2)) / (F.col("n") - 1)).alias("std")
    )
    bandwidth = spread.withColumn("h", F.col("std") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).where("h > 0")
    step = (F.col("hi") - F.col("lo")) / F.lit(points - 1)
    reach = F.lit(KERNEL_REACH) * F.col("h")
    first = F.greatest(F.floor((F.col("value") - reach - F.col("lo")) / step), F.lit(0))
    last = F.least(F.ceil((F.col("value") + reach - F.col("lo")) / step), F.lit(points - 1))
    near = counted.join(F.broadcast(bandwidth), "metric").withColumn("point", F.explode(F.sequence(first, last)))
    x = F.col("lo") + F.col("point") * (F.col("hi") - F.col("lo")) / F.lit(points - 1)
    distance = (x - F.col("value")) / F.col("h")
    kernel = F.col("cnt") * F.exp(distance * distance * F.lit(-0.5))
    kept = ["metric", "point", "n", "lo", "hi", "h"]
    every = bandwidth.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1)).cast("array<bigint>")))
    masses = near.select(*kept, kernel.alias("mass")).union(every.select(*kept, F.lit(0.0)))
    summed = masses.groupBy(*kept).agg(F.sum("mass").alias("mass"))
    norm = F.col("n") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi())
    return summed.select("metric", F.col("point").cast("int").alias("point"), x.alias("x"), (F.col("mass") / norm).alias("density"))


def binned_density(
    df: DataFrame, columns: Sequence[str] = CHARTED_COLUMNS, points: int = DENSITY_POINTS, fineness: int = BINS_PER_BANDWIDTH
) -> DataFrame:
    """As ``density``, from bin masses instead of distinct values: for columns with about as many values as rows.

    Each value's weight goes to its two neighbouring bin nodes in proportion to its nearness, which evaluates the kernel by
    linear interpolation between nodes. With nodes ``bandwidth / fineness`` apart at most, a density is off by at most
    ``error_bound``: spacing squared over 8 times the largest second derivative of the kernel. Only bins that hold
    weight are shuffled, from tasks that have summed them, and every bin meets the grid points in its reach.
    """
    values = unpivot_numbers(df, columns)
    spread = values.groupBy("metric").agg(
        F.count("*").alias("n"), F.stddev_samp("value").alias("std"), F.min("value").alias("lo"), F.max("value").alias("hi")
    )
    sized = spread.withColumn("h", F.col("std") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).where("h > 0")
    step = (F.col("hi") - F.col("lo")) / F.lit(points - 1)
    # Whole numbers of bins to a grid step, so that grid points are nodes. One row per listed column: safe to broadcast.
    grid = sized.withColumn("step", step).withColumn("m", F.ceil(F.col("step") * fineness / F.col("h"))).withColumn("delta", F.col("step") / F.col("m"))
    place = (F.col("value") - F.col("lo")) / F.col("delta")
    shared = values.join(F.broadcast(grid), "metric").select("metric", F.floor(place).alias("node"), (place - F.floor(place)).alias("part"))
    ends = F.array(F.struct("node", (1 - F.col("part")).alias("mass")), F.struct((F.col("node") + 1).alias("node"), F.col("part").alias("mass")))
    bins = shared.select("metric", F.inline(ends)).groupBy("metric", "node").agg(F.sum("mass").alias("mass")).where("mass > 0")
    reach = F.lit(BINNED_REACH) * F.col("h") / F.col("step")
    at = F.col("node") / F.col("m")
    first, last = F.greatest(F.ceil(at - reach), F.lit(0)), F.least(F.floor(at + reach), F.lit(points - 1))
    near = bins.join(F.broadcast(grid), "metric").where(first <= last).withColumn("point", F.explode(F.sequence(first, last)))
    distance = (F.col("point") - at) * F.col("step") / F.col("h")
    every = grid.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1)).cast("array<bigint>")))
    kept = ["metric", "point", "n", "lo", "h", "step", "delta"]
    masses = near.select(*kept, (F.col("mass") * F.exp(distance * distance * F.lit(-0.5))).alias("mass")).union(every.select(*kept, F.lit(0.0)))
    summed = masses.groupBy(*kept).agg(F.sum("mass").alias("mass"))
    peak = 1 / (F.col("h") * F.sqrt(F.lit(2.0) * F.pi()))
    return summed.select(
        "metric", F.col("point").cast("int").alias("point"), (F.col("lo") + F.col("point") * F.col("step")).alias("x"),
        (F.col("mass") / F.col("n") * peak).alias("density"), (F.pow(F.col("delta") / F.col("h"), 2) / 8 * peak).alias("error_bound"),
    )


def box_summary(
    df: DataFrame, columns: Sequence[str] = CHARTED_COLUMNS, keys: Sequence[str] = (), precount: bool = True
) -> DataFrame:
    """Quartiles, whiskers snapped to the data and the values beyond them, per column and key."""
    group = [*keys, "metric"]
    values = _weighted_values(df, columns, keys, precount)
    quartiles = widen_quantiles(
        exact_quantiles(values, group, [0.25, 0.5, 0.75]), group, {0.25: "q1", 0.5: "median", 0.75: "q3"}
    )
    reach = F.lit(WHISKER) * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        values.join(per_group(quartiles, group), group)
        .groupBy(*group, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("cnt"))), F.lit(0)).alias("outliers"),
        )
    )


def bounded_sample(df: DataFrame, columns: Sequence[str], key_columns: Sequence[str], size: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``size`` rows with the smallest digests of their key columns: random-like, repeatable.

    A histogram over the first four digest characters (65,536 counters) finds how far the sample
    reaches, so only about ``size`` rows plus one bucket take part in the final ordering.
    """
    digested = df.withColumn("_digest", row_digest(key_columns))
    bucket = F.substring("_digest", 1, 4)
    counts = digested.groupBy(bucket.alias("b")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    reach = counts.withColumn("before", before).where(F.col("before") < size).agg(F.max("b").alias("b"))
    near = digested.where(bucket <= reach.scalar())
    return near.orderBy("_digest", *columns).limit(size).select(*columns)


def loss_share(df: DataFrame) -> DataFrame:
    """Share of lines sold at a loss per discount bucket."""
    loss = F.count_if(F.col("profit_margin_pct") < 0)
    return df.groupBy("discount_bucket").agg(
        F.count("*").alias("line_count"), loss.alias("loss_lines"), ratio(loss, F.count("*")).alias("loss_share")
    )


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"), F.lit(len(df.columns)).alias("column_count"))
