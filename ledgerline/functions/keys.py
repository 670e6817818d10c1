"""Text keys, display names and row digests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from ledgerline.functions.numbers import col_of

# Printf formats of the business keys.
CUSTOMER_KEY = "CUST-%05d"
PRODUCT_KEY = "PROD-%05d"
ORDER_KEY = "ORD-%06d"


def business_key(number: str | Column, template: str) -> Column:
    """Padded text key; a number with more digits than the padding keeps all of them."""
    return F.format_string(template, col_of(number))


def display_name(adjective: str | Column, noun: str | Column) -> Column:
    """Adjective and noun in the singular (one trailing ``s`` is taken off)."""
    return F.concat_ws(" ", col_of(adjective), F.regexp_replace(col_of(noun), "s$", ""))


def row_digest(columns: Sequence[str]) -> Column:
    """md5 over the named columns: a stable key for rows that have no short one.

    Decimals and dates print the same in every engine, doubles do not: cast them before.
    """
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns]))
