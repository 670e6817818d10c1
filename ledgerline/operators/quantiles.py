"""Exact quantiles by successive narrowing, without sorting the data or gathering it in one task.

The built-in exact percentile keeps every distinct value of a group in one buffer. Here values are read as whole numbers
in the same order (``with_order_code``), and each round counts rows by the next sixteen bits of the numbers that still share
the wanted rank's leading bits: at most 65,536 counters per task and interval, whatever the values. After four rounds all
64 bits are known and the interval is one value. The values that the first round leaves are stored for the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from ledgerline.operators.stored import stored


def unpivot_numbers(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), keep_missing: bool = False
) -> DataFrame:
    """(keys, metric, value) rows of the named columns as doubles.

    Missing values are left out, or kept as NaN where rows without a value must still be counted.
    """
    typed = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    rows = typed.unpivot(list(keys), list(columns), "metric", "value")
    if keep_missing:
        return rows.withColumn("value", F.coalesce("value", F.lit(float("nan"))))
    return rows.where(F.col("value").isNotNull() & ~F.isnan("value"))


def value_counts(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per distinct value, stored for the readers below. The counts are shuffled by key and value, so no key gathers
    in one task, and a costly input is computed once."""
    return stored(values.groupBy(*keys, "value").agg(F.count("*").alias("cnt")))


#: Bits that are left to look at after each round.
SHIFTS = (48, 32, 16, 0)


def with_order_code(df: DataFrame, value: str = "value", name: str = "code") -> DataFrame:
    """Adds the double as a 64-bit whole number in the same order: sign, exponent and fraction as they are stored.

    Infinite values lie next to all finite ones, as they are stored too. The steps are columns of their own, because an
    expression that names one twice would compute it twice, down to the logarithm.
    """
    x, least, most = F.col(value), -1022, 1023
    infinite = F.abs(x) == float("inf")
    sized = df.withColumn("_size", F.when(infinite, F.lit(1.0)).otherwise(F.abs(x)))
    rough = sized.withColumn("_rough", F.when(F.col("_size") > 0, F.greatest(F.least(F.floor(F.log2("_size")), F.lit(most)), F.lit(least))).otherwise(least))
    power = rough.withColumn("_power", F.pow(F.lit(2.0), F.col("_rough")))
    # The logarithm may miss the exponent by one next to a power of two.
    miss = F.when((F.col("_size") < F.col("_power")) & (F.col("_rough") > least), -1).when(F.col("_size") / 2 >= F.col("_power"), 1).otherwise(0)
    missed = power.withColumn("_miss", miss)
    scale = F.when(F.col("_miss") < 0, F.col("_power") / 2).when(F.col("_miss") > 0, F.col("_power") * 2).otherwise(F.col("_power"))
    split = missed.withColumn("_fraction", F.col("_size") / scale)
    normal = F.col("_fraction") >= 1
    lead = F.when(normal, F.col("_rough") + F.col("_miss") + 1023).otherwise(0).cast("long")
    rest = ((F.col("_fraction") - F.when(normal, 1.0).otherwise(0.0)) * float(1 << 52)).cast("long")
    coded = split.withColumn("_code", F.when(infinite, F.lit(2047 << 52)).otherwise(F.shiftleft(lead, 52) + rest))
    return coded.withColumn(name, F.when(x < 0, -F.col("_code")).otherwise(F.col("_code"))).select(*df.columns, name)


def exact_quantiles(counted: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(keys, prob, quantile) with linear interpolation between neighbouring ranks.

    ``counted`` has the keys, a double ``value`` (NaN is ignored) and its frequency ``cnt``. ``keys`` must not be
    empty. Besides the data only one row per key and probability is in flight.
    """
    keys = list(keys)
    coded = with_order_code(counted.where(~F.isnan("value")))
    whole = _binned(coded, None, keys, SHIFTS[0])
    n = F.sum("size").over(W.partitionBy(*keys))
    spots = [((F.col("n") - 1) * F.lit(float(p)), float(p)) for p in probs]
    wanted = F.array(
        *[
            F.struct(F.lit(p).alias("prob"), F.floor(spot).alias("rank"), (spot - F.floor(spot)).alias("weight"))
            for spot, p in spots
        ]
    )
    targets = _hit(whole.withColumn("n", n).select("*", F.inline(wanted)).withColumn("after", F.lit(None).cast("double")), keys)
    # The first sixteen bits leave few values: later rounds read these and not the whole input again.
    targets = stored(targets)
    intervals = per_group(targets.select(*keys, "lo", "hi").distinct(), keys)  # equal ones or apart, so no value is met twice
    inside = F.col("value").between(F.col("lo"), F.col("hi"))
    left = stored(coded.join(intervals, keys).where(inside).groupBy(*keys, "value", "code").agg(F.sum("cnt").alias("cnt")))
    for shift in SHIFTS[1:]:
        targets = _hit(_binned(left, per_group(targets, keys), [*keys, *_TARGET], shift), keys)
    exhausted = F.col("rank") + 1 >= F.col("left")
    upper = F.when(exhausted, F.coalesce("after", "lo")).otherwise(F.col("lo"))
    between = F.col("lo") + (upper - F.col("lo")) * F.col("weight")
    infinite = (F.abs(F.col("lo")) == float("inf")) | (F.abs(upper) == float("inf"))
    # Differences of infinite values are no numbers: next to one, the neighbours are weighted instead.
    weighted = F.col("lo") * (1 - F.col("weight")) + upper * F.col("weight")
    only = (F.col("weight") == 0) | (F.col("lo") == upper)
    return targets.select(*keys, "prob", F.when(only, F.col("lo")).when(infinite, weighted).otherwise(between).alias("quantile"))


#: State of a search: the rank inside the interval, and the smallest value above the interval.
_TARGET = ["prob", "rank", "weight", "after"]


def per_group(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Without further keys there is a row per listed column and probability, which fits a broadcast whatever the data.
    With keys the choice is left to the sizes at run time."""
    return F.broadcast(frame) if list(keys) == ["metric"] else frame


def _binned(coded: DataFrame, intervals: DataFrame | None, group: list[str], shift: int) -> DataFrame:
    """Rows per bin of every interval with the running count and the next value above each bin."""
    keys = [k for k in group if k in coded.columns]
    bounds = ["lo", "hi"] if intervals is not None else []
    if intervals is not None:
        coded = coded.join(intervals, keys).where(F.col("value").between(F.col("lo"), F.col("hi")))
    filled = coded.groupBy(*group, *bounds, F.shiftright("code", shift).alias("bin")).agg(
        F.sum("cnt").alias("size"), F.min("value").alias("bin_lo"), F.max("value").alias("bin_hi")
    )
    in_order = W.partitionBy(*group, *bounds).orderBy("bin")
    return filled.withColumns(
        {
            "upto": F.sum("size").over(in_order.rowsBetween(W.unboundedPreceding, W.currentRow)),
            "following": F.lead("bin_lo").over(in_order),
        }
    )


def _hit(binned: DataFrame, keys: list[str]) -> DataFrame:
    """The bin that holds the wanted rank becomes the next interval."""
    before = F.col("upto") - F.col("size")
    return binned.where((F.col("rank") >= before) & (F.col("rank") < F.col("upto"))).select(
        *keys,
        F.col("bin_lo").alias("lo"),
        F.col("bin_hi").alias("hi"),
        "prob",
        (F.col("rank") - before).alias("rank"),
        F.col("size").alias("left"),
        "weight",
        F.coalesce("following", "after").alias("after"),
    )


def widen_quantiles(quantiles: DataFrame, keys: Sequence[str], names: dict[float, str]) -> DataFrame:
    """One row per key with one column per probability."""
    return quantiles.groupBy(*keys).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name) for p, name in names.items()]
    )
