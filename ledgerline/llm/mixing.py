"""Mixing sources to target weights, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline.llm.common import text_of

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)

#: A source gives each of its words at most so many times.
MAX_RATE = 3

#: Changes every random copy.
SEED = "mix-1"

_HEX = 13


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")).cast("long")


def coin(docs: DataFrame, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the seed, the id and the text only."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.lit(":"), text_of(docs)))
    return F.conv(F.substring(digest, 1, _HEX), 16, 10).cast("double") / F.lit(float(16**_HEX))


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """(source, source_size, target, rate) from rows (source, size).

    Sources share the whole size by weight. A source's target stops at ``max_rate`` times its size and the excess
    goes to the others by weight: with the sources ordered by cap / weight, the common level is the largest of
    (total - caps before) / (weights from here on). Rows per source are summed before the shuffle, and the windows
    run over one row per source.
    """
    everything = Window.partitionBy(F.lit(0))
    by_cap = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumn("place", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())))
    weighted = ranked.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") - 1) % len(weights) + 1)
    ).withColumn("cap", F.col("source_size") * max_rate)
    before = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    level = weighted.withColumn("level", (F.sum("source_size").over(everything) - before).cast("double") / rest)
    target = F.least(F.col("cap").cast("double"), F.max("level").over(everything) * F.col("weight"))
    return level.withColumn("target", target).select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"),
    )


def with_copies(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds source_size, target and copies: floor(rate), and one more where the coin is below the fraction.

    The join is by value of the source, nulls included. The targets have one row per source; which side is
    broadcast is left to the sizes, and a hot source is split by AQE where both sides are shuffled.
    """
    named = targets.withColumnRenamed("source", "_source")
    fraction = F.col("rate") - F.floor("rate")
    copies = F.floor("rate").cast("long") + F.when(F.col("coin") < fraction, 1).otherwise(0)
    return sized.join(named, sized["source"].eqNullSafe(named["_source"]), "left").withColumn("copies", copies).drop("_source", "rate")


def measured(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, coin) of every row. A null text has size 0."""
    return docs.select("doc_id", docs["source"].cast("string").alias("source"), word_count(text_of(docs)).alias("size"), coin(docs, seed).alias("coin"))


def mix(docs: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE, seed: str = SEED) -> DataFrame:
    """The documents, each row as often as the mix takes it, with their own columns.

    A source's words come to its target but for the coins of its documents. Null sources form one source, null
    texts have no words, equal rows get equal coins, an empty table gives an empty table. Other columns are
    carried along; names of the operator's own columns start with an underscore pair and don't clash.
    """
    targets = source_targets(measured(docs, seed), weights, max_rate)
    kept = docs.columns
    own = F.struct(*[docs[c] for c in kept])
    sized = docs.select(own.alias("__doc"), docs["source"].cast("string").alias("source"), coin(docs, seed).alias("coin"))
    copied = with_copies(sized, targets).where("copies > 0")
    return copied.select("__doc", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("__copy")).select("__doc.*")
