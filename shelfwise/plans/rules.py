"""Queries over order baskets."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import rules
from shelfwise.plans.catalog import BASKETS_SQL, PRODUCTS_SQL, basket_items, products
from shelfwise.plans.registry import query


def itemsets_sql(item: str, min_support: float, max_len: int) -> str:
    """Itemsets level by level: each level extends the frequent ones by a larger item of the basket."""
    levels = ["l1 AS (SELECT basket, item AS last, item AS items FROM baskets)"]
    for size in range(2, max_len + 1):
        levels.append(
            f"l{size} AS (SELECT p.basket, b.item AS last, p.items || ',' || b.item AS items FROM l{size - 1} p "
            f"JOIN baskets b ON b.basket = p.basket AND b.item > p.last "
            f"WHERE p.items IN (SELECT items FROM l{size - 1} GROUP BY items HAVING count(*) / (SELECT n FROM total) >= {min_support}))"
        )
    union = " UNION ALL ".join(f"SELECT items, {s} AS size, count(*) AS n FROM l{s} GROUP BY items" for s in range(1, max_len + 1))
    return (
        BASKETS_SQL.format(item=item)
        + ", total AS (SELECT CAST(count(DISTINCT basket) AS DOUBLE) AS n FROM baskets), "
        + ", ".join(levels)
        + f", itemsets AS (SELECT items, size, u.n, u.n / total.n AS support FROM ({union}) u, total WHERE u.n / total.n >= {min_support})"
    )


def rules_sql(min_confidence: float, min_lift: float | None, max_len: int) -> str:
    lift = f"AND lift >= {min_lift}" if min_lift is not None else ""
    return f""", splits AS (
      SELECT items, support, mask, string_split(items, ',') AS arr FROM itemsets, range(1, {2**max_len}) r(mask)
      WHERE size >= 2 AND mask < (1 << size) - 1),
    sides AS (SELECT support,
        array_to_string(list_transform(list_filter(range(0, len(arr)), lambda i: (mask >> i) & 1 = 1), lambda i: arr[i + 1]), ',') AS antecedents,
        array_to_string(list_transform(list_filter(range(0, len(arr)), lambda i: (mask >> i) & 1 = 0), lambda i: arr[i + 1]), ',') AS consequents FROM splits),
    measured AS (SELECT s.antecedents, s.consequents, s.support, s.support / a.support AS confidence, (s.support / a.support) / c.support AS lift,
        s.support - a.support * c.support AS leverage, CASE WHEN s.support / a.support < 1 THEN (1 - c.support) / (1 - s.support / a.support) END AS conviction
      FROM sides s JOIN itemsets a ON a.items = s.antecedents JOIN itemsets c ON c.items = s.consequents),
    rules AS (SELECT * FROM measured WHERE confidence >= {min_confidence} {lift})"""


ROUNDED = ("support", "confidence", "lift", "leverage", "conviction")
ROUNDED_SQL = "antecedents, consequents, " + ", ".join(f"round({c}, 6) AS {c}" for c in ROUNDED)


def _shown(df):
    sides = [F.array_join(c, ",").alias(c) for c in ("antecedents", "consequents")]
    return df.select(*sides, *[F.round(c, 6).alias(c) for c in ROUNDED])


@query("frequent_itemsets", itemsets_sql("p_type", 0.05, 5) + "SELECT items, CAST(size AS INTEGER) AS size, n, round(support, 6) AS support FROM itemsets")
def frequent_itemsets(spark, sf):
    found = rules.frequent_itemsets(basket_items(spark, sf), 0.05, 5)
    return found.select(F.array_join("items", ",").alias("items"), F.size("items").alias("size"), "n", F.round("support", 6).alias("support"))


@query("association_rules", itemsets_sql("p_type", 0.05, 5) + rules_sql(0.5, 1.0, 5) + f"SELECT {ROUNDED_SQL} FROM rules")
def association_rules(spark, sf):
    return _shown(rules.association_rules(rules.frequent_itemsets(basket_items(spark, sf))))


@query("association_rules_strict", itemsets_sql("p_type", 0.1, 3) + rules_sql(0.5, None, 3) + f"SELECT {ROUNDED_SQL} FROM rules")
def association_rules_strict(spark, sf):
    itemsets = rules.frequent_itemsets(basket_items(spark, sf), 0.1, 3)
    return _shown(rules.association_rules(itemsets, 0.5, None, 3))


@query(
    "rule_summary",
    itemsets_sql("p_type", 0.05, 5) + rules_sql(0.5, None, 5)
    + "SELECT count(*) AS n_rules, round(coalesce(avg(confidence), 0), 6) AS mean_confidence, round(coalesce(avg(lift), 0), 6) AS mean_lift, round(max(lift), 6) AS max_lift FROM rules WHERE lift >= 1",
)
def rule_summary(spark, sf):
    found = rules.association_rules(rules.frequent_itemsets(basket_items(spark, sf)), 0.5, None)
    return rules.rule_summary(found).withColumns({c: F.round(c, 6) for c in ("mean_confidence", "mean_lift", "max_lift")})


@query(
    "bought_together",
    itemsets_sql("p_brand", 0.01, 2) + "SELECT split_part(items, ',', 1) AS item_a, split_part(items, ',', 2) AS item_b, n, round(support, 6) AS support FROM itemsets WHERE size = 2",
)
def bought_together(spark, sf):
    return rules.bought_together(basket_items(spark, sf, "p_brand")).withColumn("support", F.round("support", 6))


@query(
    "window_baskets",
    PRODUCTS_SQL + """, o AS (SELECT category, row_number() OVER (ORDER BY price DESC, product_id) - 1 AS position FROM products)
    SELECT position // 3 AS basket, string_agg(DISTINCT category, ',' ORDER BY category) AS items FROM o GROUP BY 1 HAVING count(*) = 3""",
)
def window_baskets(spark, sf):
    ordered = products(spark, sf).select("product_id", "price", "category")
    baskets = rules.window_baskets(ordered, [F.desc("price"), F.asc("product_id")])
    return baskets.select("basket", F.array_join("items", ",").alias("items"))
