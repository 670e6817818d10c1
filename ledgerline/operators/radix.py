"""Cutting busy groups into order-preserving chunks of bounded size, by histograms over the digits of the key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ledgerline.operators.joins import join_per_key
from ledgerline.operators.stored import stored

#: Bits of a whole number, and characters of a text, that one histogram looks at.
DIGIT_BITS = 16
DIGIT_CHARS = 2


def shared_prefix(a: str, b: str) -> Column:
    """Length of the common prefix of two text columns."""
    size = F.least(F.length(a), F.length(b))
    same = F.transform(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), lambda i: F.substring(F.col(a), i, F.lit(1)) == F.substring(F.col(b), i, F.lit(1)))
    differs = F.array_position(same, False)
    return F.when(differs > 0, differs - 1).otherwise(size).cast("int")


def with_chunks(rows: DataFrame, group: Sequence[str], key: str, limit: int) -> DataFrame:
    """Adds ``_chunk``, an array of whole numbers that orders the rows of each group as ``key`` does, chunk after chunk.

    Keys are whole numbers or texts and distinct within a group; equal ones could not be cut and stay together. A group of at most ``limit`` rows is one chunk. A larger one is
    counted by the leading digit of its keys; neighbouring digits share a chunk until it holds ``limit`` rows, and a digit with
    more rows than that is counted by its next digit, and so on. Cuts follow the counts and not the values, so no chunk
    holds more than twice ``limit`` rows, however the keys lie. Texts are read from the first character in which the
    keys of a part differ, so a common beginning of any length costs nothing; a null key counts as the smallest digit.

    A round is a few jobs over the rows of busy parts only; their number is at most four for whole numbers, and for texts half
    the characters in which keys of busy parts branch. ``rows`` is read several times: pass a stored frame.
    """
    group = list(group)
    none = F.array().cast("array<bigint>").alias("_chunk")
    busy = stored(rows.groupBy(*group).agg(F.count("*").alias("_rows")).where(F.col("_rows") > limit).select(*group))
    if busy.isEmpty():
        return rows.select("*", none)
    # Groups may be null: rows of a busy one are found with null-safe keys.
    same = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(busy[c]) for c in group])
    done = [rows.join(busy, same, "left_anti").select("*", none)]
    part = stored(rows.join(busy, same, "left_semi").select("*", none))
    whole = isinstance(rows.schema[key].dataType, T.IntegralType)
    level = 0
    while not part.isEmpty():
        split = _split(part, [*group, "_chunk"], key, limit, level if whole else None)
        split = stored(split)
        done.append(split.where(~F.col("_heavy")).drop("_heavy"))
        part = split.where("_heavy").drop("_heavy")
        level += 1
    return reduce(DataFrame.unionByName, done)


def _split(rows: DataFrame, part: list[str], key: str, limit: int, level: int | None) -> DataFrame:
    """The rows with the next number of their chunk, and ``_heavy`` where the chunk must be split again."""
    if level is None:
        text = F.col(key).cast("string")
        ends = rows.withColumn("_text", text).groupBy(*part).agg(F.min("_text").alias("_low"), F.max("_text").alias("_high"))
        ends = ends.withColumns({"_skip": F.coalesce(shared_prefix("_low", "_high"), F.lit(0)), "_last": F.col("_low").eqNullSafe(F.col("_high"))})
        known = _joined(rows, ends.drop("_low", "_high"), part)
        digit = F.coalesce(F.substring(text, F.col("_skip") + 1, F.lit(DIGIT_CHARS)), F.lit(""))
        known = known.withColumn("_digit", digit).drop("_skip")
    else:
        last = 64 // DIGIT_BITS - 1
        unsigned = F.col(key).cast("long").bitwiseXOR(F.lit(-(1 << 63)))
        place = F.shiftrightunsigned(unsigned, DIGIT_BITS * (last - level)).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))
        known = rows.withColumns({"_digit": F.coalesce(place, F.lit(-1).cast("long")), "_last": F.lit(level == last)})
    counts = known.groupBy(*part, "_digit").agg(F.count("*").alias("_rows"), F.max("_last").alias("_last"))
    before = F.sum("_rows").over(W.partitionBy(*part).orderBy("_digit").rowsBetween(W.unboundedPreceding, -1))
    heavy = (F.col("_rows") > limit) & ~F.col("_last")
    # Light digits in front of a heavy one may share its number; the last bit puts the heavy one behind them.
    step = F.floor(F.coalesce(before, F.lit(0)) / F.lit(limit)) * 2 + heavy.cast("long")
    steps = counts.select(*part, "_digit", step.cast("long").alias("_step"), heavy.alias("_heavy"))
    placed = _joined(known, steps, [*part, "_digit"])
    return placed.withColumn("_chunk", F.concat("_chunk", F.array("_step"))).select(*rows.columns, "_heavy")


def _joined(rows: DataFrame, per_key: DataFrame, keys: list[str]) -> DataFrame:
    """``join_per_key`` for keys that may be null: joined by structs of them, which compare nulls as equal."""
    packed = F.to_json(F.struct(*keys))
    side = per_key.select(packed.alias("_key"), *[c for c in per_key.columns if c not in keys])
    return join_per_key(rows.withColumn("_key", packed), side, ["_key"]).drop("_key")
