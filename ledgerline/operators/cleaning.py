"""Cleaning of flat order lines: missing values, copies, types, business rules, outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ledgerline.functions.numbers import half_even, percent
from ledgerline.operators.quantiles import exact_quantiles, unpivot_numbers, value_counts
from ledgerline.schemas import CATEGORY_COLUMNS, DATE_COLUMNS, ID_COLUMNS, NUMBER_COLUMNS

# What replaces a missing value.
FILL_VALUES = {"customer_name": "Guest Customer", "discount": 0.0}

# Fixed value: width of the outlier fences in interquartile ranges.
IQR_FENCE = 1.5


def rows_from_columns(wide: DataFrame, entries: Sequence[tuple[str, Column]], names: tuple[str, str]) -> DataFrame:
    """Turn the columns of a one-row frame into (name, value) rows."""
    structs = [F.struct(F.lit(label).alias(names[0]), value.alias(names[1])) for label, value in entries]
    return wide.select(F.inline(F.array(*structs)))


def null_profile(df: DataFrame) -> DataFrame:
    """Columns that hold nulls, with their count; one aggregation over all columns."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = rows_from_columns(wide, [(c, F.col(c)) for c in df.columns], ("column_name", "null_count"))
    return rows.where("null_count > 0")


def fill_missing(df: DataFrame) -> DataFrame:
    present = {c: v for c, v in FILL_VALUES.items() if c in df.columns}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in present.items()})


def fill_decisions(df: DataFrame) -> DataFrame:
    """One row per filled column: how many values were missing and what they became."""
    present = {c: v for c, v in FILL_VALUES.items() if c in df.columns}
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in present])
    structs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled_count"), F.lit(str(v)).alias("filled_with"))
        for c, v in present.items()
    ]
    return wide.select(F.inline(F.array(*structs))).where("filled_count > 0")


def remove_copies(df: DataFrame) -> DataFrame:
    """Full-row distinct, nulls equal. Copies collapse in the map-side aggregation before the shuffle."""
    return df.dropDuplicates()


def _whole_number(column: Column) -> Column:
    number = column.try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("int"))


def convert_types(df: DataFrame) -> DataFrame:
    """Typed columns; a value that does not parse becomes null."""
    casts: dict[str, Column] = {}
    for c in df.columns:
        if c in DATE_COLUMNS:
            casts[c] = F.col(c).try_cast("date")
        elif c in ID_COLUMNS or c in CATEGORY_COLUMNS:
            casts[c] = F.col(c).cast("string")
        elif c in NUMBER_COLUMNS and not isinstance(df.schema[c].dataType, T.DecimalType):
            casts[c] = F.col(c).try_cast("double")
        elif c == "quantity":
            casts[c] = _whole_number(F.col(c))
    return df.withColumns(casts)


def conversion_audit(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns whose type changed, read off the two schemas."""
    rows = [
        (f.name, before.schema[f.name].dataType.simpleString(), f.dataType.simpleString())
        for f in after.schema
        if f.name in before.columns and before.schema[f.name].dataType != f.dataType
    ]
    return before.sparkSession.createDataFrame(rows, "column_name string, type_before string, type_after string")


def conversion_report(before: DataFrame) -> DataFrame:
    """Per column: type before and after the conversion, values given, and values that did not parse."""
    after = convert_types(before)
    types = {f.name: (before.schema[f.name].dataType.simpleString(), f.dataType.simpleString()) for f in after.schema}
    both = before.select(*[F.col(c).isNotNull().alias(f"_given_{c}") for c in before.columns], *before.columns)
    converted = convert_types(both)
    wide = converted.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"), F.lit(types[c][0]).alias("type_before"), F.lit(types[c][1]).alias("type_after"),
                F.count_if(f"_given_{c}").alias("given"), F.count_if(F.col(f"_given_{c}") & F.col(c).isNull()).alias("unparsed"),
            ).alias(c)
            for c in before.columns
        ]
    )
    return wide.select(F.inline(F.array(*before.columns)))


def _holds(condition: Column) -> Column:
    """A comparison with null counts as not violated."""
    return F.coalesce(condition, F.lit(False))


def shipped_before_ordered() -> Column:
    return _holds(F.col("ship_date") < F.col("order_date"))


def sales_not_positive() -> Column:
    return _holds(F.col("sales") <= 0)


def quantity_not_positive() -> Column:
    return _holds(F.col("quantity") <= 0)


def repair_ship_dates(df: DataFrame) -> DataFrame:
    repaired = F.when(shipped_before_ordered(), F.date_add("order_date", 1)).otherwise(F.col("ship_date"))
    return df.withColumn("ship_date", repaired)


def drop_invalid_amounts(df: DataFrame) -> DataFrame:
    """Drop lines with sales <= 0 (unknown sales stay) and lines without a quantity above zero."""
    return df.where(~sales_not_positive()).where(F.col("quantity") > 0)


def rule_violations(df: DataFrame) -> DataFrame:
    """Violated rules and the rows they affect; quantity is judged on lines whose sales pass."""
    wide = df.agg(
        F.count_if(shipped_before_ordered()).alias("ship"),
        F.count_if(sales_not_positive()).alias("sales"),
        F.count_if(~sales_not_positive() & quantity_not_positive()).alias("quantity"),
    )
    entries = [
        ("ship_date before order_date", F.col("ship")),
        ("sales <= 0", F.col("sales")),
        ("quantity <= 0", F.col("quantity")),
    ]
    return rows_from_columns(wide, entries, ("rule", "violations")).where("violations > 0")


def clean(df: DataFrame, copies: bool = False) -> DataFrame:
    """The whole cleaning chain as one plan with one shuffle (the copy removal).

    ``copies=True`` keeps the copies, for readers whose result is the same with them: their columns alone are then computed,
    while finding copies takes every column of every line.
    """
    filled = df.transform(fill_missing)
    return (
        (filled if copies else remove_copies(filled))
        .transform(convert_types)
        .transform(repair_ship_dates)
        .transform(drop_invalid_amounts)
    )


def shape_audit(df: DataFrame) -> DataFrame:
    """Rows and columns before and after cleaning and the copies removed, from a single pass."""
    return shape_of_counted(counted_copies(fill_missing(df)))


def counted_copies(df: DataFrame) -> DataFrame:
    """The different rows, nulls equal, with the number of their copies as ``_copies``."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))


def shape_of_counted(counted: DataFrame) -> DataFrame:
    """As ``shape_audit``, from the ``counted_copies`` of filled rows."""
    typed, columns = convert_types(counted), len(counted.columns) - 1
    kept = ~sales_not_positive() & _holds(F.col("quantity") > 0)
    return typed.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows_before"),
        F.lit(columns).alias("columns_before"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("copies_removed"),
        F.count_if(kept).alias("rows_after"),
        F.lit(columns).alias("columns_after"),
    )


def iqr_fences(df: DataFrame, columns: Sequence[str] = ("sales", "profit"), precount: bool = True) -> DataFrame:
    """Exact quartiles and strict outlier fences per column, with the rows outside them."""
    values = unpivot_numbers(df, columns, keep_missing=True)
    values = value_counts(values, ["metric"]) if precount else values.withColumn("cnt", F.lit(1).cast("long"))
    quartiles = (
        exact_quantiles(values, ["metric"], [0.25, 0.75])
        .groupBy("metric")
        .agg(
            F.max(F.when(F.col("prob") == 0.25, F.col("quantile"))).alias("q1"),
            F.max(F.when(F.col("prob") == 0.75, F.col("quantile"))).alias("q3"),
        )
        .withColumn("lower_bound", F.col("q1") - IQR_FENCE * (F.col("q3") - F.col("q1")))
        .withColumn("upper_bound", F.col("q3") + IQR_FENCE * (F.col("q3") - F.col("q1")))
    )
    # NaN stands for a missing value: it counts as a row, never as an outlier.
    outside = ~F.isnan("value") & ~F.col("value").between(F.col("lower_bound"), F.col("upper_bound"))
    # One row per listed column: a fixed size, safe to broadcast.
    counted = (
        values.join(F.broadcast(quartiles), "metric")
        .groupBy("metric", "q1", "q3", "lower_bound", "upper_bound")
        .agg(
            F.coalesce(F.sum(F.when(outside, F.col("cnt"))), F.lit(0)).alias("outliers"),
            F.sum("cnt").alias("rows"),
        )
    )
    return counted.select(
        "metric", "q1", "q3", "lower_bound", "upper_bound", "outliers",
        half_even(percent("outliers", "rows"), 2).alias("outlier_pct"),
    )


def outlier_flags(df: DataFrame, columns: Sequence[str] = ("sales", "profit"), precount: bool = True) -> DataFrame:
    """The lines with one boolean per column telling whether the value lies outside the fences."""
    fences = iqr_fences(df, columns, precount).groupBy().agg(
        F.map_from_entries(
            F.collect_list(F.struct("metric", F.struct("lower_bound", "upper_bound")))
        ).alias("fences")
    )
    flags = {}
    for c in columns:
        fence = fences.scalar()[c]
        inside = F.col(c).cast("double").between(fence["lower_bound"], fence["upper_bound"])
        flags[f"is_{c}_outlier"] = _holds(~inside)
    return df.withColumns(flags)


#: Values listed per column, and values a task keeps count of while it looks for the frequent ones.
PROFILE_VALUES = 20
PROFILE_TRACKED = 10_000


def category_profile(
    df: DataFrame, columns: Sequence[str] = CATEGORY_COLUMNS, top: int = PROFILE_VALUES, tracked: int = PROFILE_TRACKED
) -> DataFrame:
    """(column_name, position, value, row_count, share_pct, is_complete): the most frequent values of each column as text.

    One pass finds the candidates of all columns with sketches that hold at most ``tracked`` values, whatever a column
    contains; a second counts these exactly and nothing else. With up to ``tracked`` distinct values the list is exact; with more, a
    value too rare for the sketch (below about 3.5 / ``tracked`` of the rows) may be missing. Ties go by value.
    ``is_complete`` tells whether the listed values are all that the column has. Nulls are not values.
    """
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    sketched = text.agg(*[F.expr(f"approx_top_k(`{c}`, {4 * top}, {tracked})").alias(c) for c in columns], *[F.count(c).alias(f"_n_{c}") for c in columns])
    entries = [(c, F.struct(F.transform(F.col(c), lambda i: i["item"]).alias("items"), F.col(f"_n_{c}").alias("n"))) for c in columns]
    found = rows_from_columns(sketched, entries, ("column_name", "found")).select("column_name", "found.items", "found.n")
    values = text.unpivot([], list(columns), "column_name", "value").where("value IS NOT NULL")
    # One row per listed column with at most 4 * top values: a fixed size, safe to broadcast.
    kept = values.join(F.broadcast(found), "column_name").where(F.array_contains("items", F.col("value")))
    counted = kept.groupBy("column_name", "value", "n").agg(F.count("*").alias("row_count"))
    by_count = W.partitionBy("column_name").orderBy(F.desc("row_count"), "value")
    ranked = counted.withColumn("position", F.row_number().over(by_count)).where(F.col("position") <= top)
    return ranked.select(
        "column_name", "position", "value", "row_count", half_even(percent("row_count", "n"), 2).alias("share_pct"),
        (F.sum("row_count").over(W.partitionBy("column_name")) == F.col("n")).alias("is_complete"),
    )
