"""Integrity audits: keys, references, required columns, checks, lengths. They report, never enforce."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.operators.cleaning import rows_from_columns, shipped_before_ordered
from ledgerline.schemas import DECIMAL_LIMITS, TEXT_LENGTHS


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def primary_key_audit(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Per table: key values that occur more than once and the rows too many."""
    reports = []
    for name, (df, key) in tables.items():
        per_key = df.groupBy(*key).agg(F.count("*").alias("n"))
        reports.append(
            per_key.agg(
                F.lit(name).alias("table_name"),
                F.lit(",".join(key)).alias("key_columns"),
                F.count_if(F.col("n") > 1).alias("repeated_keys"),
                F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
            )
        )
    return _union(reports)


def foreign_key_audit(references: Sequence[tuple[str, DataFrame, str, str, DataFrame, str]]) -> DataFrame:
    """Per reference (child name, child, column, parent name, parent, column): orphan keys and rows.

    Child rows are counted per key before the anti join, so a hot key crosses the shuffle once per task.
    """
    reports = []
    for child_name, child, child_key, parent_name, parent, parent_key in references:
        used = child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("k")).agg(
            F.count("*").alias("n")
        )
        orphans = used.join(parent.select(F.col(parent_key).alias("k")), "k", "left_anti")
        reports.append(
            orphans.agg(
                F.lit(child_name).alias("child_table"),
                F.lit(parent_name).alias("parent_table"),
                F.lit(child_key).alias("key_column"),
                F.count("*").alias("orphan_keys"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
            )
        )
    return _union(reports)


def not_null_audit(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Null count of every required column, zeros included."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return rows_from_columns(wide, [(c, F.col(c)) for c in required], ("column_name", "null_count"))


def check_audit(df: DataFrame) -> DataFrame:
    """Rows that break a check; a null passes, as it does in a table constraint."""

    def broken(condition: Column) -> Column:
        return F.count_if(F.coalesce(~condition, F.lit(False)))

    wide = df.agg(
        F.count_if(shipped_before_ordered()).alias("ship"),
        broken(F.col("sales") > 0).alias("sales"),
        broken(F.col("quantity") > 0).alias("quantity"),
        broken(F.col("discount").between(0, 1)).alias("discount"),
    )
    entries = [
        ("ship_date >= order_date", F.col("ship")),
        ("sales > 0", F.col("sales")),
        ("quantity > 0", F.col("quantity")),
        ("discount between 0 and 1", F.col("discount")),
    ]
    return rows_from_columns(wide, entries, ("check_name", "broken_rows"))


def length_audit(
    df: DataFrame,
    lengths: Mapping[str, int] = TEXT_LENGTHS,
    decimals: Mapping[str, tuple[int, int]] = DECIMAL_LIMITS,
) -> DataFrame:
    """Values too long for their text column, or too wide for their decimal column."""
    checks = _oversized(df, lengths, decimals)
    wide = df.agg(*[F.count_if(F.coalesce(check, F.lit(False))).alias(c) for c, check in checks.items()])
    return rows_from_columns(wide, [(c, F.col(c)) for c in checks], ("column_name", "oversized_values"))


def table_audit(df: DataFrame) -> DataFrame:
    """(column_name, rule, broken_rows): nulls of every column and oversized values, from one pass over the table."""
    checks = [(c, "not null", F.col(c).isNull()) for c in df.columns]
    checks += [(c, "length", check) for c, check in _oversized(df, TEXT_LENGTHS, DECIMAL_LIMITS).items()]
    wide = df.agg(*[F.count_if(F.coalesce(check, F.lit(False))).alias(f"_{k}") for k, (_, _, check) in enumerate(checks)])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.lit(rule).alias("rule"), F.col(f"_{k}").alias("broken_rows"))
        for k, (c, rule, _) in enumerate(checks)
    ]
    return wide.select(F.inline(F.array(*rows)))


def _oversized(df: DataFrame, lengths: Mapping[str, int], decimals: Mapping[str, tuple[int, int]]) -> dict[str, Column]:
    checks = {c: F.length(F.col(c).cast("string")) > n for c, n in lengths.items() if c in df.columns}
    for c, (precision, scale) in decimals.items():
        if c in df.columns:
            fits = F.col(c).try_cast(f"decimal({precision},{scale})")
            checks[c] = F.col(c).isNotNull() & fits.isNull()
    return checks
