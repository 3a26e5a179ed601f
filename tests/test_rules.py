import itertools
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import rules

BASKETS = [("milk", "bread"), ("milk", "diapers"), ("bread", "diapers"), ("milk", "bread", "diapers")]


def items_of(spark, baskets):
    return spark.createDataFrame([(i, x) for i, b in enumerate(baskets) for x in b], "basket int, item string")


def test_worked_example(spark):
    itemsets = rules.frequent_itemsets(items_of(spark, BASKETS), 0.1)
    support = {tuple(r["items"]): r.support for r in itemsets.collect()}
    assert len(support) == 7
    assert {support[k] for k in support if len(k) == 1} == {0.75}
    assert {support[k] for k in support if len(k) == 2} == {0.5}
    assert support[("bread", "diapers", "milk")] == 0.25
    found = rules.association_rules(itemsets, 0.5, None).collect()
    assert len(found) == 9
    pairs = [r for r in found if len(r.antecedents) == 1]
    triples = [r for r in found if len(r.antecedents) == 2]
    assert len(pairs) == 6 and len(triples) == 3
    for r in pairs:
        assert (r.confidence, r.lift, r.leverage, r.conviction) == pytest.approx((2 / 3, 0.8889, -0.0625, 0.75), abs=1e-4)
    for r in triples:
        assert (r.support, r.confidence, r.lift, r.leverage, r.conviction) == pytest.approx((0.25, 0.5, 2 / 3, -0.125, 0.5))
    assert rules.association_rules(itemsets, 0.5, 1.0).count() == 0
    assert rules.rule_summary(rules.association_rules(itemsets, 0.5, 1.0)).first().n_rules == 0


def test_repeated_items_and_sure_rule(spark):
    itemsets = rules.frequent_itemsets(items_of(spark, [("a", "a", "b"), ("a", "b"), ("c",)]), 0.5)
    assert {tuple(r["items"]): r.n for r in itemsets.collect()} == {("a",): 2, ("b",): 2, ("a", "b"): 2}
    sure = rules.association_rules(itemsets).collect()
    assert {(r.confidence, r.conviction) for r in sure} == {(1.0, None)}


def test_an_item_may_hold_a_comma_and_lift_sorts(spark):
    baskets = [("a,b", "c"), ("a,b", "c"), ("a", "d"), ("a", "d"), ("a", "c"), ("e", "f"), ("e", "f")]
    found = rules.association_rules(rules.frequent_itemsets(items_of(spark, baskets), 0.2)).collect()
    assert (["a,b"], ["c"]) in [(r.antecedents, r.consequents) for r in found]
    assert [r.lift for r in found] == sorted((r.lift for r in found), reverse=True) and len({r.lift for r in found}) > 1


def test_against_brute_force_with_a_hot_basket(spark):
    rng = random.Random(3)
    baskets = [{f"i{rng.randrange(12)}" for _ in range(rng.randrange(1, 7))} for _ in range(200)]
    baskets.append({f"x{i}" for i in range(500)} | {"i1", "i2"})
    found = rules.frequent_itemsets(items_of(spark, baskets), 0.1, 3)
    want = {}
    names = sorted({x for b in baskets for x in b if x.startswith("i")})
    for size in (1, 2, 3):
        for combo in itertools.combinations(names, size):
            n = sum(set(combo) <= b for b in baskets)
            if n / len(baskets) >= 0.1:
                want[combo] = n
    assert {tuple(r["items"]): r.n for r in found.collect()} == want


def test_support_at_the_limit(spark):
    # 3 of 30 baskets is exactly 0.1
    baskets = [("a",)] * 3 + [("b",)] * 27
    assert {r["items"][0] for r in rules.frequent_itemsets(items_of(spark, baskets), 0.1).collect()} == {"a", "b"}


def test_window_baskets(spark):
    def run(text):
        df = spark.createDataFrame([(i, c) for i, c in enumerate(text)], "i int, category string")
        return [set(r["items"]) for r in rules.window_baskets(df, [F.asc("i")]).orderBy("basket").collect()]

    assert run("ABACCDE") == [{"A", "B"}, {"C", "D"}]
    assert run("AB") == [{"A", "B"}]
    assert run(["", None, "A"]) == [{"uncategorized", "A"}]


def test_bought_together(spark):
    pairs = {(r.item_a, r.item_b): r.n for r in rules.bought_together(items_of(spark, BASKETS)).collect()}
    assert pairs == {("bread", "diapers"): 2, ("bread", "milk"): 2, ("diapers", "milk"): 2}
