"""Calendar columns derived from a date."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

from ledgerline.functions.numbers import col_of

# Festive months, and the demand weight of the months that differ from 1.0.
FESTIVE_MONTHS = (10, 11)
SEASONAL_WEIGHTS = {10: Decimal("1.6"), 11: Decimal("1.6"), 1: Decimal("1.3"), 12: Decimal("1.2")}
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def month_start(day: str | Column) -> Column:
    return F.trunc(col_of(day), "MM")


def month_end(day: str | Column) -> Column:
    return F.last_day(col_of(day))


def week_end(day: str | Column) -> Column:
    """The Sunday that closes the Monday-to-Sunday week of the date."""
    return F.date_add(F.trunc(col_of(day), "week"), 6)


def weekday_name(day: str | Column) -> Column:
    return F.date_format(col_of(day), "EEEE")


def month_name(day: str | Column) -> Column:
    return F.date_format(col_of(day), "MMM")


def month_label(day: str | Column, long: bool = False) -> Column:
    return F.date_format(col_of(day), "MMMM yyyy" if long else "yyyy-MM")


def is_weekend(day: str | Column) -> Column:
    return F.weekday(col_of(day)).isin(5, 6)


def is_festive(day: str | Column) -> Column:
    return F.month(col_of(day)).isin(*FESTIVE_MONTHS)


def seasonal_weight(day: str | Column) -> Column:
    month = F.month(col_of(day))
    weight = None
    for number, value in SEASONAL_WEIGHTS.items():
        weight = F.when(month == number, F.lit(value)) if weight is None else weight.when(month == number, F.lit(value))
    return weight.otherwise(F.lit(Decimal("1.0")))
