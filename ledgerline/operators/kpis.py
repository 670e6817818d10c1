"""Business figures over order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ledgerline.functions import calendar as cal
from ledgerline.functions.labels import retention_label
from ledgerline.functions.numbers import half_even, money_sum, percent, ratio


def _grouped(df: DataFrame, *keys: str):
    """Group by keys; rows without a key belong to no group."""
    return df.dropna(subset=list(keys)).groupBy(*keys)


def headline(df: DataFrame) -> DataFrame:
    """The core figures as one row, from one pass.

    Lines are first reduced to one row per customer and order. Each of these goes once to its customer and once to
    its order, so that distinct customers, distinct orders and repeat customers come from one aggregation.
    """
    pairs = df.groupBy("customer_id", "order_id").agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit"))
    nothing = [F.lit(None).cast(pairs.schema[c].dataType).alias(c) for c in ("sales", "profit")]
    sides = F.array(
        F.struct(F.lit("customer").alias("side"), F.col("customer_id").cast("string").alias("id"), F.col("order_id").isNotNull().cast("int").alias("one"), "sales", "profit"),
        F.struct(F.lit("order").alias("side"), F.col("order_id").cast("string").alias("id"), F.lit(0).alias("one"), *nothing),
    )
    ends = pairs.select(F.inline(sides)).groupBy("side", "id").agg(
        F.sum("one").alias("orders"), F.sum("sales").alias("sales"), F.sum("profit").alias("profit")
    )
    known = F.col("id").isNotNull()
    customer = (F.col("side") == "customer") & known
    with_repeats = ends.agg(
        money_sum("sales").alias("total_sales"),
        money_sum("profit").alias("total_profit"),
        F.count_if((F.col("side") == "order") & known).alias("total_orders"),
        F.count_if(customer).alias("total_customers"),
        F.count_if(customer & (F.col("orders") > 1)).alias("repeat_customers"),
    )
    rate = percent("repeat_customers", "total_customers")
    return with_repeats.select(
        "total_sales",
        "total_profit",
        percent("total_profit", "total_sales").alias("profit_margin_pct"),
        "total_orders",
        "total_customers",
        ratio("total_sales", "total_orders").alias("average_order_value"),
        ratio("total_sales", "total_customers").alias("customer_lifetime_value"),
        "repeat_customers",
        rate.alias("repeat_customer_rate_pct"),
        retention_label(rate).alias("retention"),
    )


def top_products(df: DataFrame, n: int = 10) -> DataFrame:
    """Best-selling products by id, name and category."""
    return (
        _grouped(df, "product_id", "product_name", "category")
        .agg(
            money_sum("sales").alias("total_sales"),
            money_sum("profit").alias("total_profit"),
            F.sum("quantity").alias("units_sold"),
        )
        .orderBy(F.desc("total_sales"), "product_id")
        .limit(n)
    )


def top_products_by_name(df: DataFrame, n: int = 10) -> DataFrame:
    """Best-selling product names, smallest first, with the category of the earliest line."""
    # Reduced by hash aggregation first, so that the arg-min sorts only these groups.
    reduced = df.dropna(subset=["product_name"]).groupBy("product_name", "category", "order_date").agg(
        F.sum("sales").alias("sales"), F.min("order_id").alias("order_id")
    )
    named = reduced.groupBy("product_name").agg(
        money_sum("sales").alias("total_sales"),
        F.min_by("category", F.struct("order_date", "order_id", "category")).alias("category"),
    )
    return named.orderBy(F.desc("total_sales"), "product_name").limit(n).orderBy("total_sales", F.desc("product_name"))


def regional(df: DataFrame) -> DataFrame:
    """Sales, profit, distinct orders and share of all sales per region, largest first."""
    grouped = df.groupBy("region").agg(
        money_sum("sales").alias("total_sales"),
        money_sum("profit").alias("total_profit"),
        F.countDistinct("order_id").alias("order_count"),
    )
    everything = F.sum("total_sales").over(W.partitionBy())
    # The whole includes lines without a region, the rows do not.
    shares = grouped.withColumn("sales_share_pct", half_even(percent("total_sales", everything), 2))
    return shares.where(F.col("region").isNotNull()).orderBy(F.desc("total_sales"), "region")


def regional_share(df: DataFrame) -> DataFrame:
    """Slices of the regional pie, one decimal."""
    grouped = _grouped(df, "region").agg(money_sum("sales").alias("total_sales"))
    everything = F.sum("total_sales").over(W.partitionBy())
    return grouped.withColumn("share_pct", half_even(percent("total_sales", everything), 1)).orderBy(
        F.desc("total_sales"), "region"
    )


def category_sales(df: DataFrame) -> DataFrame:
    return _grouped(df, "category").agg(money_sum("sales").alias("total_sales")).orderBy("total_sales", "category")


def category_summary(df: DataFrame) -> DataFrame:
    """Sales, mean of the line margins (not the margin of the sums) and distinct orders per category."""
    # Line margins have two decimals: as decimals their sum is exact and independent of the order.
    margin = F.col("profit_margin_pct").cast("decimal(18,2)")
    return (
        _grouped(df, "category")
        .agg(
            money_sum("sales").alias("total_sales"),
            half_even(ratio(F.sum(margin), F.count(margin)), 2).alias("avg_margin_pct"),
            F.countDistinct("order_id").alias("order_count"),
        )
        .orderBy(F.desc("total_sales"), "category")
    )


def sales_heatmap(df: DataFrame) -> DataFrame:
    """Category by month name; an absent cell is zero, a month absent everywhere is null."""
    months = list(cal.MONTH_NAMES)
    dated = df.dropna(subset=["category"]).withColumn("_month", cal.month_name("order_date"))
    pivoted = dated.groupBy("category").pivot("_month", months).agg(money_sum("sales"))
    anywhere = W.partitionBy()
    return pivoted.select(
        "category",
        *[F.when(F.max(m).over(anywhere).isNotNull(), F.coalesce(m, F.lit(0.0))).alias(m) for m in months],
    )


def date_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date"))
