from __future__ import annotations

import itertools
import random
from collections import Counter
from itertools import combinations

import pytest
from row_sets import rows
from pyspark.sql import functions as F

from ledgerline.operators import baskets

# Published rules (orders together, confidence both ways, lift) out of 5,000 baskets.
PUBLISHED = [
    (6, 0.0606, 0.0659, 3.33), (6, 0.0667, 0.0594, 3.3), (6, 0.0732, 0.0508, 3.1), (5, 0.0562, 0.0543, 3.053),
    (6, 0.0577, 0.0577, 2.774), (5, 0.0446, 0.061, 2.722), (5, 0.0495, 0.0549, 2.72), (5, 0.0581, 0.0467, 2.717),
    (5, 0.0463, 0.0581, 2.692), (5, 0.0575, 0.0463, 2.661), (6, 0.0508, 0.0625, 2.648), (6, 0.0588, 0.0536, 2.626),
    (5, 0.0446, 0.0575, 2.566), (5, 0.049, 0.0521, 2.553), (6, 0.0541, 0.0556, 2.503), (5, 0.0505, 0.0485, 2.452),
    (5, 0.0521, 0.0463, 2.411), (5, 0.049, 0.0481, 2.357), (5, 0.0476, 0.049, 2.334), (5, 0.0463, 0.05, 2.315),
    (5, 0.0495, 0.0467, 2.313), (5, 0.0543, 0.042, 2.284), (5, 0.0581, 0.0391, 2.271), (5, 0.0413, 0.0549, 2.27),
    (5, 0.05, 0.0446, 2.232), (5, 0.05, 0.0446, 2.232), (5, 0.0476, 0.0463, 2.205), (5, 0.0459, 0.0481, 2.205),
    (5, 0.0435, 0.0505, 2.196), (5, 0.042, 0.0521, 2.188), (5, 0.0476, 0.0459, 2.184), (5, 0.0463, 0.0467, 2.163),
    (5, 0.0521, 0.0413, 2.152), (5, 0.0481, 0.0446, 2.146), (6, 0.0536, 0.048, 2.143), (5, 0.0459, 0.0463, 2.124),
    (5, 0.0459, 0.0463, 2.124), (5, 0.0459, 0.0463, 2.124), (5, 0.0385, 0.0549, 2.113), (5, 0.0385, 0.0549, 2.113),
    (5, 0.0472, 0.0446, 2.106), (5, 0.0463, 0.0455, 2.104), (6, 0.0504, 0.0496, 2.083), (5, 0.041, 0.0505, 2.07),
    (5, 0.0463, 0.0446, 2.067), (5, 0.049, 0.042, 2.06), (5, 0.0463, 0.0439, 2.031), (5, 0.0505, 0.0397, 2.004),
    (6, 0.0504, 0.0476, 2.001), (5, 0.0476, 0.042, 2.001), (5, 0.0446, 0.0446, 1.993), (5, 0.0495, 0.0397, 1.964),
    (5, 0.0463, 0.042, 1.945), (5, 0.0439, 0.0435, 1.907), (5, 0.0463, 0.041, 1.897), (5, 0.0385, 0.0481, 1.849),
    (5, 0.0439, 0.042, 1.843), (5, 0.0439, 0.042, 1.843), (5, 0.0439, 0.0413, 1.812), (5, 0.0463, 0.0391, 1.808),
    (5, 0.0427, 0.042, 1.796), (5, 0.0459, 0.0391, 1.792), (5, 0.0385, 0.0463, 1.781), (5, 0.042, 0.042, 1.765),
    (5, 0.04, 0.0435, 1.739),
]


def test_published_lifts_follow_from_their_counts(spark):
    data = [(f"a{i:02d}", f"b{i:02d}", n, round(n / ab), round(n / ba)) for i, (n, ab, ba, _) in enumerate(PUBLISHED)]
    counted = spark.createDataFrame(data, "item_a string, item_b string, co_occurrence_count bigint, orders_a bigint, orders_b bigint")
    rules = baskets.measure_rules(counted, F.lit(5000)).orderBy("product_a").collect()
    for rule, (n, ab, ba, lift) in zip(rules, PUBLISHED, strict=True):
        assert (rule["support"], rule["confidence_a_to_b"], rule["confidence_b_to_a"]) == (n / 5000, ab, ba)
        assert rule["lift"] == pytest.approx(lift, abs=0.0011)


def brute_force(data, min_support, min_lift):
    orders = {}
    for order, item in data:
        orders.setdefault(order, set()).add(item)
    n = len(orders)
    single = Counter(i for b in orders.values() for i in b)
    pairs = Counter(p for b in orders.values() for p in combinations(sorted(b), 2))
    rules = []
    for (a, b), c in pairs.items():
        lift = (c / n) / ((single[a] / n) * (single[b] / n))
        if c / n >= min_support and lift >= min_lift:
            rules.append((a, b, c, round(c / n, 5), round(c / single[a], 4), round(c / single[b], 4), round(lift, 3)))
    return sorted(rules, key=repr)


def shop(spark, data):
    return spark.createDataFrame(data, "order_id int, product_id string")


def test_rules_equal_a_brute_force_count(spark):
    data = [(i % 40, f"p{(i * i + i // 7) % 9}") for i in range(200)]
    data += [(7, f"p{i}") for i in range(9)] * 3  # one order with every item, bought again and again
    got = rows(baskets.association_rules(shop(spark, data), min_support=0.05, min_lift=1.0))
    assert [r[:3] for r in got] == [r[:3] for r in brute_force(data, 0.05, 1.0)]
    for mine, other in zip(got, brute_force(data, 0.05, 1.0)):
        assert mine[3:] == pytest.approx(other[3:], abs=1e-3)


def test_a_hot_order_is_cut_to_frequent_items_without_changing_the_rules(spark):
    data = [(0, f"rare{i:04d}") for i in range(2000)]  # a third and more of all rows in one basket
    data += [(i, f"p{j}") for i in range(1, 60) for j in range(8) if (i + j) % 3]
    data += [(0, "p1"), (0, "p2")]
    frame = shop(spark, data)
    assert rows(baskets.pair_counts(baskets.basket_items(frame), 0.05), "item_a", "item_b", "co_occurrence_count") == sorted(
        (r[0], r[1], r[2]) for r in brute_force(data, 0.05, 0.0)
    )


def test_no_rules_gives_an_empty_table(spark):
    rules = baskets.association_rules(shop(spark, [(1, "a"), (2, "b")]))
    assert rules.count() == 0 and "lift" in rules.columns
    assert baskets.recommendations(rules).count() == 0


def test_recommendations_rank_by_lift_then_rule_order(spark):
    rules = spark.createDataFrame(
        [("a", "b", 2.0), ("a", "c", 3.0), ("a", "d", 2.0), ("a", "e", 1.5), ("a", "f", 1.4), ("a", "g", 1.3), ("b", "c", 9.0)],
        "product_a string, product_b string, lift double",
    )
    ranked = baskets.recommendations(rules)
    assert [r["recommended"] for r in ranked.where("product = 'a'").orderBy("rank").collect()] == ["c", "b", "d", "e", "f"]
    lists = {r["product"]: r["recommended"] for r in baskets.recommendation_lists(ranked).collect()}
    assert lists["c"] == ["b", "a"] and lists["g"] == ["a"]


def test_lists_names_and_evidence(spark):
    df = spark.createDataFrame(
        [(1, "y", "Old Y", 1), (1, "x", "X", 1), (1, "x", "X", 1), (2, "y", "New Y", 2), (2, None, "?", 2)],
        "order_id int, product_id string, product_name string, order_date int",
    )
    assert {r["order_id"]: r["items"] for r in baskets.baskets(df, "product_id").collect()} == {1: ["x", "y"], 2: ["y"]}
    assert rows(baskets.item_names(df)) == [("x", "X"), ("y", "Old Y")]
    rules = baskets.association_rules(df, min_support=0.1, min_lift=0.1)
    assert tuple(baskets.rule_evidence(rules, baskets.basket_items(df)).first()) == (2, 2, 1, 1, 1)
    top = baskets.top_rules(rules, baskets.item_names(df)).first()
    assert (top["name_a"], top["name_b"]) == ("X", "Old Y")


def test_itemsets_of_every_size_equal_counting_all_subsets(spark):
    rng = random.Random(8)
    orders = [rng.sample("abcdefgh", rng.randint(1, 6)) for _ in range(120)] + [list("abcde")] * 20
    frame = spark.createDataFrame([(k, i) for k, order in enumerate(orders) for i in order], "order_id long, item string")
    counted = Counter(c for order in orders for size in (2, 3, 4) for c in itertools.combinations(sorted(order), size))
    for support in (0.05, 0.12, 0.2):
        expected = sorted((list(c), len(c), n) for c, n in counted.items() if n / len(orders) >= support)
        found = sorted((r["items"], r["size"], r["order_count"]) for r in baskets.itemsets(frame, support).collect())
        assert found == expected and max(size for _, size, _ in found) >= 3
    assert baskets.itemsets(frame, 0.99).collect() == [] == baskets.itemsets(frame.limit(0), 0.1).collect()


def test_candidates_lose_sets_with_an_infrequent_part(spark):
    known = spark.createDataFrame([(list(p), 9) for p in ("ab", "ac", "bc", "bd", "ad")], "set array<string>, order_count long")
    assert rows(baskets._candidates(known, 3)) == sorted([(["a", "b"], "c"), (["a", "b"], "d")], key=repr)


def test_lists_are_refused_for_a_large_domain(spark):
    frame = spark.range(50).selectExpr("id % 5 AS order_id", "id AS item")
    assert baskets.baskets(frame, "item", max_domain=50).count() == 5
    with pytest.raises(ValueError, match="more than 49"):
        baskets.baskets(frame, "item", max_domain=49)


def test_sets_meet_their_own_orders_before_candidates(spark):
    """An order's sets are not multiplied by the candidates: a stored, small candidate table is sent to the tasks."""
    from ledgerline.operators.stored import stored_table

    kept = stored_table(spark.createDataFrame([(o, i) for o in range(20) for i in "abc"], "order_id long, item string"))
    held = kept.selectExpr("order_id", "array(item) AS set")
    candidates = stored_table(spark.createDataFrame([(["a"], "b"), (["a"], "z")], "start array<string>, item string"))
    grown = baskets._occurrences(held, kept, candidates)
    assert [r["set"] for r in grown.collect()] == [["a", "b"]] * 20
    plan = grown._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftSemi") < plan.index("Join Inner")
