"""Rounding and division with the semantics the published figures use."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def col_of(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_double(value: str | Column) -> Column:
    return col_of(value).cast("double")


def half_even(value: str | Column, digits: int) -> Column:
    """Round a double half to even on the scaled value, as array libraries do."""
    scale = float(10**digits)
    return F.rint(as_double(value) * scale) / scale


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Double quotient; null instead of an error or an infinity when dividing by zero."""
    return F.try_divide(as_double(numerator), as_double(denominator))


def percent(numerator: str | Column, denominator: str | Column) -> Column:
    return ratio(numerator, denominator) * 100.0


def money_sum(value: str | Column) -> Column:
    """Sum kept exact while it is a decimal and turned into a double last."""
    return F.sum(col_of(value)).cast("double")
