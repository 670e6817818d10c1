"""Bucket and label columns. Comparisons with null fall through to the last branch on purpose."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerline.functions.numbers import as_double

# Label texts and thresholds.
DISCOUNT_BUCKETS = ("No Discount", "Low (1-20%)", "Medium (21-35%)", "High (36%+)")
ORDER_SIZES = ("Small", "Medium", "Large")
ORDER_SIZE_LIMITS = (2000.0, 15000.0)


def discount_bucket(discount: str | Column) -> Column:
    rate = as_double(discount)
    none, low, medium, high = DISCOUNT_BUCKETS
    return F.when(rate == 0.0, none).when(rate <= 0.2, low).when(rate <= 0.35, medium).otherwise(high)


def order_size(total: str | Column, limits: tuple[float, float] = ORDER_SIZE_LIMITS) -> Column:
    value = as_double(total)
    small, medium, large = ORDER_SIZES
    return F.when(value < limits[0], small).when(value < limits[1], medium).otherwise(large)


def skew_label(skewness: str | Column) -> Column:
    value = as_double(skewness)
    return (
        F.when(value > 0.5, "right-skewed").when(value < -0.5, "left-skewed").otherwise("roughly symmetric")
    )


def retention_label(repeat_rate_pct: str | Column) -> Column:
    value = as_double(repeat_rate_pct)
    return F.when(value > 50.0, "strong").when(value > 25.0, "moderate").otherwise("weak")
