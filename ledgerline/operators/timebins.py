"""Month and week bins without gaps, growth between bins, and the chronological split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerline.functions import calendar as cal
from ledgerline.functions.numbers import half_even, money_sum, ratio

# Fixed value: share of the last weeks held out for testing.
TEST_FRACTION = 0.15


def fill_gaps(binned: DataFrame, bin_column: str, months: bool, keys: Sequence[str] = ()) -> DataFrame:
    """Add the missing bins between the first and the last one, measures set to zero.

    Every bin emits itself and the empty bins up to the next one, so the aggregate is read once. The
    window runs over bins, whose number is bounded by the calendar.
    """
    column = F.col(bin_column)
    step = F.expr("interval 1 month") if months else F.expr("interval 7 days")
    back = F.add_months("_next", -1) if months else F.date_sub("_next", 7)
    measures = [c for c in binned.columns if c != bin_column and c not in keys]
    spread = binned.withColumn("_next", F.lead(column).over(W.partitionBy(*keys).orderBy(column))).withColumn(
        "_bin", F.explode(F.sequence(column, F.coalesce(back, column), step))
    )
    own = F.col("_bin") == column
    return spread.select(
        *keys,
        F.col("_bin").alias(bin_column),
        *[F.when(own, F.col(m)).otherwise(F.lit(0)).alias(m) for m in measures],
    )


def growth_pct(value: Column, order: Column, keys: Sequence[str] = ()) -> Column:
    """Change against the previous bin in percent; null for the first bin and after a zero."""
    previous = F.lag(value).over(W.partitionBy(*keys).orderBy(order))
    return half_even((ratio(value, previous) - 1.0) * 100.0, 2)


def monthly_bins(df: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """Measures per calendar month, labelled by the month's last day in ``order_date``."""
    grouped = (
        df.where(F.col("order_date").isNotNull())
        .groupBy(cal.month_start("order_date").alias("_month"))
        .agg(*[expr.alias(name) for name, expr in measures.items()])
    )
    filled = fill_gaps(grouped, "_month", months=True)
    return filled.select(cal.month_end("_month").alias("order_date"), *measures)


def monthly_trend(df: DataFrame) -> DataFrame:
    """Sales, profit, distinct orders and growth per month."""
    monthly = monthly_bins(
        df,
        {
            "total_sales": money_sum("sales"),
            "total_profit": money_sum("profit"),
            "order_count": F.countDistinct("order_id"),
        },
    )
    return monthly.withColumn("mom_growth_pct", growth_pct(F.col("total_sales"), F.col("order_date")))


def last_bins(binned: DataFrame, bin_column: str, n: int) -> DataFrame:
    return binned.orderBy(F.desc(bin_column)).limit(n).orderBy(bin_column)


def peak_and_low(monthly: DataFrame) -> DataFrame:
    """Best and worst month by sales, the earliest one on a tie."""
    month, sales = F.col("order_date"), F.col("total_sales")
    # Days since the epoch, negated: the larger key is the earlier month.
    earlier = -F.unix_date(month)
    found = F.struct(month.alias("month_end"), sales.alias("total_sales"))
    extremes = monthly.agg(
        F.max_by(found, F.struct(sales, earlier)).alias("peak"),
        F.max_by(found, F.struct(-sales, earlier)).alias("low"),
    )
    rows = extremes.select(
        F.inline(F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("at")) for kind in ("peak", "low")]))
    )
    return rows.select(
        "kind",
        cal.month_label("at.month_end").alias("month"),
        cal.month_label("at.month_end", long=True).alias("month_name"),
        F.col("at.total_sales").alias("total_sales"),
    )


def weekly_sales(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sales per week labelled by its Sunday, without gaps; optionally one series per key."""
    grouped = (
        df.where(F.col("order_date").isNotNull())
        .groupBy(*keys, cal.week_end("order_date").alias("week_end"))
        .agg(money_sum("sales").alias("total_sales"))
    )
    return fill_gaps(grouped, "week_end", months=False, keys=keys)


def add_week_features(weekly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Time index and calendar columns of the week-end date."""
    day = F.col("week_end")
    first = F.min(day).over(W.partitionBy(*keys))
    return weekly.withColumns(
        {
            "time_index": F.floor(F.datediff(day, first) / 7).cast("int"),
            "month": F.month(day),
            "quarter": F.quarter(day),
            "week_of_year": F.weekofyear(day),
            "is_festive_season": cal.is_festive(day).cast("int"),
        }
    )


def chronological_split(weekly: DataFrame, keys: Sequence[str] = (), test_fraction: float = TEST_FRACTION) -> DataFrame:
    """Mark the first weeks of each series as training data; never a random draw."""
    weeks = F.count("*").over(W.partitionBy(*keys))
    return weekly.withColumn("is_train", F.col("time_index") < F.floor(weeks * F.lit(1 - test_fraction)))


def split_bounds(split: DataFrame) -> DataFrame:
    return split.groupBy("is_train").agg(
        F.min("week_end").alias("first_week"), F.max("week_end").alias("last_week"), F.count("*").alias("weeks")
    )
