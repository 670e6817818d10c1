"""Flat order lines to customers, products, orders and order items, and back to one joined summary."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from ledgerline.functions.keys import row_digest
from ledgerline.operators.joins import join_per_key
from ledgerline.schemas import (
    CUSTOMER_COLUMNS, DECIMAL_LIMITS, ID_COLUMNS, ITEM_COLUMNS, ORDER_COLUMNS, PRODUCT_COLUMNS, SUMMARY_COLUMNS,
)


def first_per_key(df: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of every value of ``columns[0]`` in the given order; ties are broken by the columns
    themselves. Each task keeps one row per key before the shuffle, so a hot key stays small."""
    key, *rest = columns
    ranked = df.select(*dict.fromkeys([*columns, *order])).withColumn(
        "_position", F.row_number().over(W.partitionBy(key).orderBy(*order, *[c for c in rest if c not in order]))
    )
    return ranked.where("_position = 1").select(*columns)


def keyed(lines: DataFrame) -> DataFrame:
    """Lines that can be loaded: the key columns of all tables are required."""
    return lines.dropna(subset=list(ID_COLUMNS))


def customers(lines: DataFrame) -> DataFrame:
    return first_per_key(keyed(lines), CUSTOMER_COLUMNS, ["order_date", "order_id", "product_id"])


def customers_preferring_names(lines: DataFrame, guest: str = "Guest Customer") -> DataFrame:
    """As ``customers``, but a line with a real name wins over an earlier guest line."""
    marked = keyed(lines).withColumn("_guest", F.col("customer_name") == guest)
    return first_per_key(marked, CUSTOMER_COLUMNS, ["_guest", "order_date", "order_id", "product_id"])


def products(lines: DataFrame) -> DataFrame:
    return first_per_key(keyed(lines), PRODUCT_COLUMNS, ["order_date", "order_id"])


def order_headers(lines: DataFrame) -> DataFrame:
    """One header per order; dates lose any time of day."""
    dated = keyed(lines).withColumns({c: F.col(c).cast("date") for c in ("order_date", "ship_date")})
    return first_per_key(dated, ORDER_COLUMNS, ["product_id", "order_date", "ship_date"])


def order_items(lines: DataFrame) -> DataFrame:
    """Line facts; a missing discount takes the column default of zero, amounts become decimals."""
    typed = keyed(lines).withColumns(
        {c: F.col(c).cast(f"decimal({p},{s})") for c, (p, s) in DECIMAL_LIMITS.items()}
    )
    return typed.withColumn(
        "discount", F.coalesce("discount", F.lit(0).cast("decimal(4,2)"))
    ).select(*ITEM_COLUMNS)


def number_items(items: DataFrame, digits: int = 4) -> DataFrame:
    """Dense, repeatable line numbers 1..N without a global sort.

    Rows fall into ``16 ** digits`` buckets by their digest, whatever their keys. A running count over
    the buckets gives each its first number, and a row's position inside the bucket is added to it. The
    numbers follow the whole digest, then the columns: ``digits`` sets the number of buckets and changes none.
    The digest is computed again behind the shuffle: it does not compress, and would be half of a shuffled row.
    """
    bucketed = items.withColumn("_bucket", F.substring(row_digest(ITEM_COLUMNS), 1, digits))
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("_bucket", F.coalesce(before, F.lit(0)).alias("_before"))
    position = F.row_number().over(W.partitionBy("_bucket").orderBy("_digest", *ITEM_COLUMNS))
    return (
        bucketed.repartition("_bucket")
        .withColumn("_digest", row_digest(ITEM_COLUMNS))
        .withColumn("_position", position)
        .join(offsets, "_bucket")
        .select((F.col("_before") + F.col("_position")).alias("order_item_id"), *ITEM_COLUMNS)
    )


def with_load_time(df: DataFrame) -> DataFrame:
    return df.withColumn("created_at", F.current_timestamp())


def order_summary(
    items: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame, keep: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Inner star join of the four tables. Sizes choose the strategy: small dimensions are broadcast by
    their statistics, large ones are sort-merged with skewed partitions split.

    Customers join the orders, which are fewer than the items, and products join the items while these are narrow: no
    customer column is shuffled with the items. Further columns of the orders come last.

    ``keep`` stores both sides of the last join one after the other (``stored_table``): the shuffles of one are gone before
    those of the next are written, so the disk holds the largest step and not all of them.
    """
    keep = keep or (lambda df: df)
    placed = keep(join_per_key(orders, customers, ["customer_id"]))
    joined = join_per_key(keep(join_per_key(items, products, ["product_id"])), placed, ["order_id"])
    further = [c for c in orders.columns if c not in SUMMARY_COLUMNS]
    return joined.select(*[c for c in SUMMARY_COLUMNS if c in joined.columns], *further)
