"""Feature columns of order lines: calendar, shipping, money, customer history, order totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerline.functions import calendar as cal
from ledgerline.functions.labels import discount_bucket, order_size
from ledgerline.functions.numbers import half_even, percent, ratio
from ledgerline.operators.joins import join_per_key
from ledgerline.operators.radix import with_chunks
from ledgerline.operators.stored import stored_table

#: Columns that tell a line about later orders of its customer: never use them to predict.
LEAKY_COLUMNS = ("customer_lifetime_order_count", "is_repeat_customer")


def add_time_features(df: DataFrame) -> DataFrame:
    day = F.col("order_date")
    return df.withColumns(
        {
            "order_year": F.year(day),
            "order_month": F.month(day),
            "order_quarter": F.quarter(day),
            "order_day_of_week": cal.weekday_name(day),
            "is_weekend": cal.is_weekend(day),
            "is_festive_season": cal.is_festive(day),
        }
    )


def add_shipping_features(df: DataFrame) -> DataFrame:
    return df.withColumn("days_to_ship", F.datediff("ship_date", "order_date"))


def add_financial_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "unit_price": half_even(ratio("sales", "quantity"), 2),
            "profit_margin_pct": half_even(percent("profit", "sales"), 2),
            "discount_bucket": discount_bucket("discount"),
        }
    )


#: Orders of a customer's day that are ranked in one window.
CHUNK_ORDERS = 1 << 16


def order_profile(lines: DataFrame, chunk_orders: int = CHUNK_ORDERS) -> DataFrame:
    """One row per order with its total and its place in the customer's history.

    The place is the rank by (date, order id) among the customer's orders. A customer may own a large
    part of all orders, so no window spans a whole customer at order level. The rank is put together
    from three bounded windows: customers by day (one row per calendar day), days by key chunk, and
    orders inside one chunk of one day. The orders are stored once for all of them.
    """
    orders = (
        lines.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id", "order_id", "order_date")
        .agg(F.sum("sales").alias("order_total_sales"))
    )
    orders = with_chunks(stored_table(orders), ["customer_id", "order_date"], "order_id", chunk_orders)
    place = ["customer_id", "order_date", "_chunk"]
    upto_previous = (W.unboundedPreceding, -1)

    chunks = orders.groupBy(*place).agg(F.count("*").alias("_orders"))
    within_day = W.partitionBy("customer_id", "order_date").orderBy("_chunk").rowsBetween(*upto_previous)
    placed = chunks.withColumn("_before_chunk", F.coalesce(F.sum("_orders").over(within_day), F.lit(0)))

    days = chunks.groupBy("customer_id", "order_date").agg(F.sum("_orders").alias("_day_orders"))
    history = W.partitionBy("customer_id")
    days = days.select(
        "customer_id",
        "order_date",
        F.coalesce(
            F.sum("_day_orders").over(history.orderBy("order_date").rowsBetween(*upto_previous)), F.lit(0)
        ).alias("_before_day"),
        F.min("order_date").over(history).alias("customer_first_order_date"),
        F.sum("_day_orders").over(history).cast("int").alias("customer_lifetime_order_count"),
    )

    in_chunk = F.row_number().over(W.partitionBy(*place).orderBy("order_id"))
    return (
        orders.withColumn("_in_chunk", in_chunk)
        .join(placed.join(days, ["customer_id", "order_date"]), place)
        .select(
            "customer_id",
            "order_id",
            "order_date",
            "order_total_sales",
            "customer_first_order_date",
            (F.col("_before_day") + F.col("_before_chunk") + F.col("_in_chunk"))
            .cast("int")
            .alias("customer_total_orders_to_date"),
            "customer_lifetime_order_count",
        )
    )


def _with_leak_note(name: str, value: Column) -> Column:
    return value.alias(name, metadata={"leaky": True})


def _customer_columns(df: DataFrame, carried: list[str]) -> DataFrame:
    lifetime = F.col("customer_lifetime_order_count")
    return df.select(
        *carried,
        "customer_first_order_date",
        F.datediff("order_date", "customer_first_order_date").alias("customer_tenure_days"),
        "customer_total_orders_to_date",
        _with_leak_note("customer_lifetime_order_count", lifetime),
        _with_leak_note("is_repeat_customer", F.coalesce(lifetime > 1, F.lit(False))),
    )


def add_customer_features(df: DataFrame) -> DataFrame:
    """First order, tenure, running order count (safe) and lifetime order count (leaky).

    The join back is on the order, one profile row each: it cannot multiply lines, and a hot order is
    split by the skew join. Lines without a customer keep null features.
    """
    profile = order_profile(df).drop("order_total_sales")
    joined = df.join(profile, ["customer_id", "order_id", "order_date"], "left")
    return _customer_columns(joined, df.columns)


def add_order_features(df: DataFrame) -> DataFrame:
    """Order total on every line and the size class of the order."""
    totals = df.groupBy("order_id").agg(F.sum("sales").alias("order_total_sales"))
    joined = join_per_key(df, totals, ["order_id"], "left")
    return joined.select(*df.columns, "order_total_sales", order_size("order_total_sales").alias("order_size_category"))


#: What a profile adds to the headers.
PROFILE_COLUMNS = (
    "order_total_sales", "customer_first_order_date", "customer_total_orders_to_date", "customer_lifetime_order_count",
)


def profiled_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    """The order headers with their profile columns: lines then meet both in one join."""
    totals = items.groupBy("order_id").agg(F.sum("sales").alias("sales"))
    profile = order_profile(join_per_key(orders, totals, ["order_id"]))
    return join_per_key(orders, profile.select("order_id", *PROFILE_COLUMNS), ["order_id"])


def feature_table(summary: DataFrame) -> DataFrame:
    """All feature columns of the order summary, where an order has exactly one customer and date.

    Customer and order features share one order-level aggregate. A summary of ``profiled_orders`` has them on its lines; to any
    other they are joined. The wide columns are computed behind the joins.
    """
    known = set(PROFILE_COLUMNS) <= set(summary.columns)
    joined = summary if known else summary.join(order_profile(summary), ["customer_id", "order_id", "order_date"])
    base = (
        joined.transform(add_time_features)
        .transform(add_shipping_features)
        .transform(add_financial_features)
    )
    carried = [c for c in base.columns if c not in PROFILE_COLUMNS]
    named = _customer_columns(base.withColumnRenamed("order_total_sales", "_total"), [*carried, "_total"])
    return named.withColumns(
        {"order_total_sales": F.col("_total"), "order_size_category": order_size("_total")}
    ).drop("_total")
