"""The retail order lines as a view over the star-schema test tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerline.schemas import MONEY, ORDER_LINE_COLUMNS, RATE, STAR_SCHEMAS

# Margin range (low, high) by product type, and the part of a discount that eats margin.
MARGIN_RANGES = {
    ("ECONOMY", "PROMO"): (Decimal("0.03"), Decimal("0.15")),
    ("STANDARD", "MEDIUM"): (Decimal("0.05"), Decimal("0.18")),
    ("SMALL", "LARGE"): (Decimal("0.10"), Decimal("0.35")),
}
DISCOUNT_EROSION = Decimal("0.6")


@dataclass(frozen=True)
class StarTables:
    """Lazy handles on the tables of one data directory."""

    spark: SparkSession
    directory: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{self.directory.rstrip('/')}/{name}.parquet")


def margin_rate(product_type: Column, product_key: Column) -> Column:
    """Base margin of a product: a point inside the range of its type, fixed by its key."""

    def pick(index: int) -> Column:
        branches = [(F.lit(rng[index]), product_type.isin(*types)) for types, rng in MARGIN_RANGES.items()]
        return reduce(
            lambda chain, b: chain.when(b[1], b[0]) if chain is not None else F.when(b[1], b[0]), branches, None
        )

    step = F.pmod(product_key, F.lit(100)).cast("decimal(2,0)") * F.lit(Decimal("0.01"))
    return (pick(0) + (pick(1) - pick(0)) * step).cast("decimal(5,4)")


def net_sales(price: Column, discount: Column) -> Column:
    return (price.cast("decimal(12,2)") * (F.lit(Decimal("1")) - discount)).cast(MONEY)


def net_profit(sales: Column, margin: Column, discount: Column) -> Column:
    rate = (margin - F.lit(DISCOUNT_EROSION) * discount).cast("decimal(5,4)")
    return (sales * rate).cast(MONEY)


def _facts(tables: StarTables) -> DataFrame:
    lines = tables.table("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_discount").cast(RATE).alias("discount"),
        "l_extendedprice",
    )
    return lines.withColumn("sales", net_sales(F.col("l_extendedprice"), F.col("discount"))).drop("l_extendedprice")


def _customers(tables: StarTables, with_place: bool) -> DataFrame:
    customers = tables.table("customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        "c_nationkey",
    )
    if not with_place:
        return customers
    places = (
        tables.table("nation")
        .join(tables.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_nationkey").alias("c_nationkey"),
            F.col("r_name").alias("country"),
            F.col("n_name").alias("city"),
            F.col("n_name").alias("state"),
            F.col("r_name").alias("region"),
        )
    )
    return customers.join(places, "c_nationkey")


def order_lines(tables: StarTables, columns: Iterable[str] = ORDER_LINE_COLUMNS) -> DataFrame:
    """Order lines joined with the headers, customers and products the asked columns need.

    The keys are declared foreign keys (``audits.foreign_key_audit`` checks them), so an inner join
    with an unused table would neither drop nor repeat rows and is left out of the plan.
    No table is hinted as broadcast: sizes decide, and skewed order or product keys are split by AQE.
    """
    columns = list(columns)
    wanted = set(columns)
    df = _facts(tables)

    if wanted & {"product_name", "category", "sub_category", "profit"}:
        parts = tables.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("sub_category"),
            margin_rate(F.col("p_type"), F.col("p_partkey")).alias("margin"),
        )
        df = df.join(parts, "product_id").withColumn(
            "profit", net_profit(F.col("sales"), F.col("margin"), F.col("discount"))
        )

    place_columns = {"country", "city", "state", "region"}
    customer_columns = {"customer_name", "segment"} | place_columns
    if wanted & ({"order_date", "ship_mode", "customer_id"} | customer_columns):
        headers = tables.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("o_orderpriority").alias("ship_mode"),
        )
        # Customers join the headers, which are fewer than the lines: lines cross the network once less.
        if wanted & customer_columns:
            headers = headers.join(_customers(tables, bool(wanted & place_columns)), "customer_id")
        df = df.join(headers, "order_id")

    return df.select(*columns)


def inject_faults(lines: DataFrame) -> DataFrame:
    """Order lines with reproducible faults: missing names and discounts, and repeated rows."""

    def fault(factor: int, modulus: int) -> Column:
        return F.pmod(F.col("order_id") * factor + F.col("product_id"), F.lit(modulus)) == 0

    faulty = lines.withColumns(
        {
            "customer_name": F.when(~fault(31, 67), F.col("customer_name")),
            "discount": F.when(~fault(17, 100), F.col("discount")),
        }
    )
    # One pass over the joined lines: a faulty row is emitted twice instead of read twice.
    copies = F.when(fault(13, 200), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return faulty.withColumn("_copy", F.explode(copies)).drop("_copy")
