"""Column layouts of the flat order lines and of the four normalized tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Eighteen digits at most in every product below keep decimal arithmetic on long integers.
MONEY = T.DecimalType(12, 2)
RATE = T.DecimalType(4, 2)

# Column names and their order in the flat order-line file.
ORDER_LINE_COLUMNS = (
    "order_id", "order_date", "ship_date", "ship_mode",
    "customer_id", "customer_name", "segment", "country", "city", "state", "region",
    "product_id", "category", "sub_category", "product_name",
    "sales", "quantity", "discount", "profit",
)

DATE_COLUMNS = ("order_date", "ship_date")
ID_COLUMNS = ("order_id", "customer_id", "product_id")
CATEGORY_COLUMNS = (
    "ship_mode", "segment", "country", "city", "state", "region", "category", "sub_category",
)
NUMBER_COLUMNS = ("sales", "discount", "profit")

#: Raw files are read as text, so that one malformed value becomes a null instead of a failed read.
RAW_TEXT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ORDER_LINE_COLUMNS])


def _order_line_type(column: str) -> T.DataType:
    if column in DATE_COLUMNS:
        return T.DateType()
    if column in NUMBER_COLUMNS:
        return T.DoubleType()
    return T.IntegerType() if column == "quantity" else T.StringType()


#: Layout of a cleaned file.
ORDER_LINE_SCHEMA = T.StructType([T.StructField(c, _order_line_type(c)) for c in ORDER_LINE_COLUMNS])

#: Star-schema input tables. Declared, so that opening a table reads no file footers.
STAR_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
}

# Columns of the normalized tables, in order.
CUSTOMER_COLUMNS = ("customer_id", "customer_name", "segment", "country", "city", "state", "region")
PRODUCT_COLUMNS = ("product_id", "product_name", "category", "sub_category")
ORDER_COLUMNS = ("order_id", "customer_id", "order_date", "ship_date", "ship_mode")
ITEM_COLUMNS = ("order_id", "product_id", "sales", "quantity", "discount", "profit")

# Columns of the joined order summary, in order.
SUMMARY_COLUMNS = (
    "order_item_id", "order_id", "order_date", "ship_date", "ship_mode",
    "customer_id", "customer_name", "segment", "country", "city", "state", "region",
    "product_id", "product_name", "category", "sub_category",
    "sales", "quantity", "discount", "profit",
)

# Text lengths and decimal (precision, scale) the tables allow.
TEXT_LENGTHS = {
    "customer_id": 20, "customer_name": 150, "segment": 30, "country": 60, "city": 80, "state": 80,
    "region": 20, "product_id": 20, "product_name": 150, "category": 50, "sub_category": 50,
    "order_id": 20, "ship_mode": 30,
}
DECIMAL_LIMITS = {"sales": (12, 2), "discount": (4, 2), "profit": (12, 2)}

# The numeric columns the exploratory statistics describe.
DESCRIBED_COLUMNS = (
    "sales", "profit", "quantity", "discount", "unit_price", "profit_margin_pct", "days_to_ship",
)
CHARTED_COLUMNS = ("sales", "profit", "quantity", "discount")
