"""Frequent itemsets, association rules and baskets."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.ordering import number_rows
from shelfwise.operators.prep import scalars
from shelfwise.session import cut_lineage


def pruned_baskets(items: DataFrame, min_support: float) -> DataFrame:
    """One row per basket holding only its frequent items, from distinct (basket, item) rows.

    Frequent items number at most (average basket size / min_support), so the
    gathered array stays small even for a basket that holds most of the rows.
    Baskets left without items stay in, since supports are shares of all baskets.
    """
    n = scalars(items, n=F.count_distinct("basket"))["n"]
    frequent = (
        items.groupBy("item")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") / n >= min_support)
        .select(F.col("item").alias("_item"))
    )
    kept = items.join(frequent, F.col("item") == F.col("_item"), "left")
    return kept.groupBy("basket").agg(F.collect_set("_item").alias("items"))


def frequent_itemsets(
    items: DataFrame, min_support: float = 0.05, max_len: int = 5, partitions: int | None = None
) -> DataFrame:
    """Itemsets with their count and support from (basket, item) rows."""
    pairs = cut_lineage(items.distinct())  # read three times below
    baskets = cut_lineage(pruned_baskets(pairs, min_support))
    total = baskets.agg(F.count(F.lit(1))).scalar()
    # the library rounds the count threshold up; the exact test follows below
    miner = FPGrowth(itemsCol="items", minSupport=max(min_support - 1e-9, 0.0), minConfidence=1.0)
    if partitions:
        miner = miner.setNumPartitions(partitions)
    found = miner.fit(baskets).freqItemsets
    itemsets = found.where(F.size("items") <= max_len).select(
        F.array_sort("items").alias("items"), F.col("freq").alias("n"), (F.col("freq") / total).alias("support")
    )
    return cut_lineage(itemsets.where(F.col("support") >= min_support))


def association_rules(
    itemsets: DataFrame, min_confidence: float = 0.5, min_lift: float | None = 1.0, max_len: int = 5
) -> DataFrame:
    """Every split of each itemset into antecedent and consequent, with the usual measures.

    A split is a bit mask over at most ``max_len`` items; both supports are equi-joins.  Sides are sorted item lists;
    the rules come with the highest lift first.
    """
    splits = itemsets.where(F.size("items").between(2, max_len)).withColumn(
        "_mask", F.explode(F.sequence(F.lit(1), (F.pow(F.lit(2), F.size("items")) - 2).cast("int")))
    )

    def side(bit: int):
        return F.filter("items", lambda x, i: F.get(F.col("_bits"), i) == bit)

    splits = splits.withColumn(
        "_bits", F.transform("items", lambda x, i: F.expr("_mask").bitwiseAND(F.pow(F.lit(2), i).cast("int")) > 0)
    ).withColumn("_bits", F.transform("_bits", lambda b: b.cast("int")))
    splits = splits.select("support", side(1).alias("antecedents"), side(0).alias("consequents"))
    a = itemsets.select(F.col("items").alias("antecedents"), F.col("support").alias("s_a"))
    c = itemsets.select(F.col("items").alias("consequents"), F.col("support").alias("s_c"))
    confidence = F.col("support") / F.col("s_a")
    rules = (
        splits.join(a, "antecedents")
        .where(confidence >= min_confidence)
        .join(c, "consequents")
        .withColumn("confidence", confidence)
        .withColumn("lift", F.col("confidence") / F.col("s_c"))
    )
    if min_lift is not None:
        rules = rules.where(F.col("lift") >= min_lift)
    conviction = F.when(F.col("confidence") < 1, (1 - F.col("s_c")) / (1 - F.col("confidence")))
    return rules.select(
        "antecedents",
        "consequents",
        "support",
        "confidence",
        "lift",
        (F.col("support") - F.col("s_a") * F.col("s_c")).alias("leverage"),
        conviction.alias("conviction"),
    ).orderBy(F.desc("lift"), "antecedents", "consequents")


def rule_summary(rules: DataFrame, min_lift: float = 1.0) -> DataFrame:
    kept = rules.where(F.col("lift") >= min_lift)
    return kept.agg(
        F.count(F.lit(1)).alias("n_rules"),
        F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("mean_confidence"),
        F.coalesce(F.avg("lift"), F.lit(0.0)).alias("mean_lift"),
        F.max("lift").alias("max_lift"),
    )


def bought_together(items: DataFrame, min_support: float = 0.01) -> DataFrame:
    """Item pairs found in the same basket, with counts."""
    pairs = frequent_itemsets(items, min_support, max_len=2).where(F.size("items") == 2)
    return pairs.select(F.get("items", F.lit(0)).alias("item_a"), F.get("items", F.lit(1)).alias("item_b"), "n", "support")


def window_baskets(df: DataFrame, order_by, field: str = "category", width: int = 3) -> DataFrame:
    """Consecutive runs of ``width`` rows as baskets of distinct values; a short tail is dropped.

    With fewer rows than ``width`` in all, they form one basket.
    """
    item = F.coalesce(F.nullif(F.col(field), F.lit("")), F.lit("uncategorized"))
    placed = number_rows(df.withColumn("_item", item), order_by)
    groups = placed.withColumn("basket", F.floor(F.col("position") / width)).groupBy("basket")
    full = groups.agg(
        F.count(F.lit(1)).alias("_n"), F.max("_total").alias("_total"), F.collect_set("_item").alias("items")
    ).where((F.col("_n") == width) | (F.col("_total") < width))
    return full.select("basket", F.array_sort("items").alias("items"))


def as_items(baskets: DataFrame) -> DataFrame:
    return baskets.select("basket", F.explode("items").alias("item"))
