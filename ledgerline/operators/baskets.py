"""Market baskets: items bought together, association rules, recommendations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerline.functions.numbers import half_even
from ledgerline.operators.joins import join_per_key
from ledgerline.operators.normalize import first_per_key
from ledgerline.operators.stored import stored_table

# Rule thresholds, recommendations per product, and what counts as thin evidence.
MIN_SUPPORT = 0.001
MIN_LIFT = 1.2
RECOMMENDATIONS = 5
THIN_EVIDENCE = 10


def basket_items(df: DataFrame, item: str = "product_id") -> DataFrame:
    """Distinct (order, item) rows: an item bought twice in one order counts once."""
    return df.select("order_id", F.col(item).alias("item")).dropna().distinct()


#: Different items up to which baskets may be kept as lists.
MAX_DOMAIN = 10_000


def baskets(df: DataFrame, item: str, max_domain: int = MAX_DOMAIN) -> DataFrame:
    """The sorted item list of every order. For items from a small fixed domain, such as brand and
    type: the list of an order is never longer than the domain, and a domain of more than ``max_domain`` items is
    refused. Rules use ``basket_items`` instead."""
    found = basket_items(df, item)
    if found.select("item").distinct().limit(max_domain + 1).count() > max_domain:
        raise ValueError(f"{item} has more than {max_domain} different values: use basket_items")
    items = found.groupBy("order_id").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return items.withColumn("item_count", F.size("items"))


def item_names(df: DataFrame, item: str = "product_id") -> DataFrame:
    """Name of each item on its earliest line."""
    named = df.select(F.col(item).alias("item"), "product_name", "order_date", "order_id").dropna(subset=["item"])
    return first_per_key(named, ["item", "product_name"], ["order_date", "order_id"])


def item_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("item").agg(F.count("*").alias("order_count"))


def _basket_total(items: DataFrame) -> Column:
    return items.agg(F.countDistinct("order_id")).scalar()


def _frequent(items: DataFrame, min_support: float) -> DataFrame:
    """Items whose own support reaches the minimum. No other item can be in a qualifying pair.

    The supports add up to the mean basket size, so at most ``mean basket size / min_support`` items
    remain, whatever the size of the catalog: this bounds every basket, a hot order included.
    """
    return item_counts(items).where(F.col("order_count") / _basket_total(items) >= min_support)


def pair_counts(items: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """Orders per unordered pair for the pairs that reach the minimum support.

    Baskets are cut to frequent items before they are paired, and each task sums its pairs before the
    shuffle. Neither changes a result: a pair is never more frequent than its rarer item.
    """
    kept = join_per_key(items, _frequent(items, min_support).select("item"), ["item"], "left_semi")
    left = kept.select("order_id", F.col("item").alias("item_a"))
    right = kept.select("order_id", F.col("item").alias("item_b"))
    pairs = left.join(right, "order_id").where(F.col("item_a") < F.col("item_b"))
    counted = pairs.groupBy("item_a", "item_b").agg(F.count("*").alias("co_occurrence_count"))
    return counted.where(F.col("co_occurrence_count") / _basket_total(items) >= min_support)


#: Items of the largest sets that ``itemsets`` looks for.
LONGEST_SET = 4


def itemsets(items: DataFrame, min_support: float = MIN_SUPPORT, longest: int = LONGEST_SET) -> DataFrame:
    """(items, size, order_count, support): all sets of 2 to ``longest`` items that reach the minimum support, by level.

    A level's candidates are two sets of the level below that share all but their last items, less those with a part that is
    not frequent itself: no frequent set is lost. Occurrences, one row per order and candidate set, are carried from level to
    level: an order's sets meet its own items, and what is no candidate goes at once. Items of a set are in order. The sum over
    orders of C(frequent items in the order, size) bounds a level; ``_frequent`` bounds the items. A level is stored before
    the next begins, as a table: its size tells Spark whether candidates and frequent sets can be sent to all tasks.
    """
    items = stored_table(items)
    total = items.agg(F.countDistinct("order_id")).first()[0]
    enough = F.col("order_count") / F.lit(total) >= F.lit(min_support)
    frequent = stored_table(item_counts(items).where(enough))
    kept = join_per_key(items, frequent.select("item"), ["item"], "left_semi")
    held = kept.select("order_id", F.array("item").alias("set"))
    known = frequent.select(F.array("item").alias("set"), "order_count")
    levels = []
    for size in range(2, longest + 1):
        grown = _occurrences(held, kept, stored_table(_candidates(known, size)))
        if size < longest:
            grown = stored_table(grown)
        known = stored_table(grown.groupBy("set").agg(F.count("*").alias("order_count")).where(enough))
        if known.isEmpty():
            break
        levels.append(known)
        held = join_per_key(grown, known.select("set"), ["set"], "left_semi")
    if not levels:
        levels = [known.limit(0)]
    every = reduce(DataFrame.union, levels)
    support = half_even(F.col("order_count") / F.lit(max(total, 1)), 5)
    return every.select(F.col("set").alias("items"), F.size("set").alias("size"), "order_count", support.alias("support"))


def _candidates(known: DataFrame, size: int) -> DataFrame:
    """(start, item): sets of ``size`` whose parts are all frequent, as the set without its last item, and that item."""
    start, last = F.slice("set", 1, size - 2), F.element_at("set", size - 1)
    left = known.select(start.alias("_start"), last.alias("_left"))
    right = known.select(start.alias("_start"), last.alias("_right"))
    pairs = left.join(right, "_start").where(F.col("_left") < F.col("_right"))
    sets = pairs.select(F.concat("_start", F.array("_left", "_right")).alias("set"))
    if size > 2:
        # The two sets that were joined are frequent; the other parts leave out one of the first items.
        parts = F.transform(F.sequence(F.lit(1), F.lit(size - 2)), lambda i: F.filter("set", lambda x, k: k != i - 1))
        each = sets.withColumn("part", F.explode(parts)).join(known.select(F.col("set").alias("part")), "part")
        sets = each.groupBy("set").agg(F.count("*").alias("n")).where(F.col("n") == size - 2).select("set")
    return sets.select(F.slice("set", 1, size - 1).alias("start"), F.element_at("set", size).alias("item"))


def _occurrences(held: DataFrame, kept: DataFrame, candidates: DataFrame) -> DataFrame:
    """(order_id, set): the candidates that each order holds, from the orders' sets of the level below and their items."""
    pairs = held.join(kept, "order_id").where(F.col("item") > F.element_at("set", -1))
    longer = pairs.select("order_id", F.col("set").alias("start"), "item")
    wanted = join_per_key(longer, candidates, ["start", "item"], "left_semi")
    return wanted.select("order_id", F.concat("start", F.array("item")).alias("set"))


def association_rules(
    df: DataFrame, item: str = "product_id", min_support: float = MIN_SUPPORT, min_lift: float = MIN_LIFT
) -> DataFrame:
    """Pair rules with support, confidence both ways and lift; thresholds apply before rounding.

    A catalog without qualifying pairs gives an empty result of the same columns.
    """
    items = basket_items(df, item)
    total = _basket_total(items)
    counts = item_counts(items)
    count_a = counts.select(F.col("item").alias("item_a"), F.col("order_count").alias("orders_a"))
    count_b = counts.select(F.col("item").alias("item_b"), F.col("order_count").alias("orders_b"))
    counted = pair_counts(items, min_support).join(count_a, "item_a").join(count_b, "item_b")
    return measure_rules(counted, total, min_lift)


def measure_rules(counted: DataFrame, total: Column, min_lift: float = MIN_LIFT) -> DataFrame:
    """Support, confidences and lift of counted pairs (item_a, item_b, co_occurrence_count, orders_a, orders_b)."""
    together = F.col("co_occurrence_count")
    support = together / total
    lift = support / ((F.col("orders_a") / total) * (F.col("orders_b") / total))
    return counted.withColumn("_lift", lift).where(F.col("_lift") >= min_lift).select(
        F.col("item_a").alias("product_a"),
        F.col("item_b").alias("product_b"),
        together,
        half_even(support, 5).alias("support"),
        half_even(together / F.col("orders_a"), 4).alias("confidence_a_to_b"),
        half_even(together / F.col("orders_b"), 4).alias("confidence_b_to_a"),
        half_even("_lift", 3).alias("lift"),
    )


def sort_rules(rules: DataFrame) -> DataFrame:
    return rules.orderBy(F.desc("lift"), "product_a", "product_b")


def recommendations(rules: DataFrame, n: int = RECOMMENDATIONS) -> DataFrame:
    """The best partners of every product by rounded lift; ties follow the order of the rules."""
    columns = ["product_a", "product_b", "lift"]
    both = rules.select(F.col("product_a").alias("product"), F.col("product_b").alias("recommended"), *columns).unionByName(
        rules.select(F.col("product_b").alias("product"), F.col("product_a").alias("recommended"), *columns)
    )
    best = W.partitionBy("product").orderBy(F.desc("lift"), "product_a", "product_b")
    return both.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n).select(
        "product", "rank", "recommended", "lift"
    )


def recommendation_lists(ranked: DataFrame) -> DataFrame:
    """One row per product with its short list (at most ``RECOMMENDATIONS`` entries) in rank order."""
    entries = F.array_sort(F.collect_list(F.struct("rank", "recommended")))
    return ranked.groupBy("product").agg(F.transform(entries, lambda e: e["recommended"]).alias("recommended"))


def top_rules(rules: DataFrame, names: DataFrame, n: int = 10) -> DataFrame:
    """The strongest rules with the names of both items."""
    best = rules.orderBy(F.desc("lift"), "product_a", "product_b").limit(n)
    # At most 2n items are wanted; the names, which may be many, are cut to them before the rules meet them.
    wanted = best.select(F.explode(F.array("product_a", "product_b")).alias("item")).distinct()
    few = names.join(F.broadcast(wanted), "item", "left_semi")
    name_a = few.select(F.col("item").alias("product_a"), F.col("product_name").alias("name_a"))
    name_b = few.select(F.col("item").alias("product_b"), F.col("product_name").alias("name_b"))
    named = best.join(F.broadcast(name_a), "product_a", "left").join(F.broadcast(name_b), "product_b", "left")
    return named.select("name_a", "name_b", *rules.columns)


def rule_evidence(rules: DataFrame, items: DataFrame) -> DataFrame:
    """How many rules rest on few orders, next to the number of pairs that were possible."""
    products = items.agg(F.countDistinct("item")).scalar()
    orders = items.agg(F.countDistinct("order_id")).scalar()
    counted = rules.agg(
        F.count("*").alias("rules"), F.count_if(F.col("co_occurrence_count") < THIN_EVIDENCE).alias("thin_rules")
    )
    return counted.select(
        orders.alias("orders"),
        products.alias("products"),
        F.floor(products * (products - 1) / 2).alias("possible_pairs"),
        "rules",
        "thin_rules",
    )
