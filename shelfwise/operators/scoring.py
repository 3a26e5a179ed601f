"""Weighted product scores and top-K selections."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.columns import clip01, or_zero, to_double
from shelfwise.functions.ordering import number_rows
from shelfwise.operators.prep import scalars

DEFAULT_WEIGHTS = {  # fixed values
    "rating": 0.30,
    "reviews_count": 0.25,
    "price_competitiveness": 0.20,
    "availability": 0.15,
    "recency": 0.10,
}


@dataclass(frozen=True)
class ScorePreset:
    """How one scorer variant treats zero maxima, clipping, rounding and optional terms."""

    availability: bool = True
    recency: bool = False
    clip: bool = False
    decimals: int | None = 4
    positive_max_price: bool = False
    null_as_zero: bool = True
    zero_max: dict[str, float] | None = field(
        default_factory=lambda: {"price": 1.0, "rating": 5.0, "reviews_count": 1.0}
    )


MAIN = ScorePreset(positive_max_price=True, zero_max=None)
CLIPPED = ScorePreset(availability=False, clip=True, decimals=None)
INTERACTIVE = ScorePreset()
VIEW = ScorePreset(zero_max=None, decimals=None, null_as_zero=False)
RECENCY = ScorePreset(recency=True, positive_max_price=True, zero_max=None)


def score(
    df: DataFrame,
    preset: ScorePreset = MAIN,
    weights: dict[str, float] | None = None,
) -> DataFrame:
    """Add ``_score``: weighted rating, reviews, inverse price, availability and recency shares."""
    w = DEFAULT_WEIGHTS if weights is None else weights
    number = or_zero if preset.null_as_zero else to_double
    price, rating, reviews = number("price"), number("rating"), number("reviews_count")
    maxima = {
        "price": F.coalesce(F.max(F.when(price > 0, price)), F.lit(1.0)) if preset.positive_max_price else F.max(price),
        "rating": F.max(rating),
        "reviews_count": F.max(reviews),
    }
    if preset.recency:
        maxima |= {"newest": F.max("updated_at"), "oldest": F.min("updated_at")}
    top = scalars(df, **maxima)

    def share(value: Column, name: str) -> Column:
        if preset.zero_max is None:
            return F.when(top[name] > 0, value / top[name])
        ceiling = F.coalesce(F.nullif(top[name], F.lit(0.0)), F.lit(preset.zero_max[name]))
        return value / ceiling

    def part(c: Column) -> Column:
        return F.coalesce(clip01(c) if preset.clip else c, F.lit(0.0))

    def weight(name: str) -> Column:
        return F.lit(float(w.get(name, 0.0)))

    total = (
        weight("rating") * part(share(rating, "rating"))
        + weight("reviews_count") * part(share(reviews, "reviews_count"))
        + weight("price_competitiveness") * part(F.lit(1.0) - share(price, "price"))
    )
    if preset.availability:
        flag = F.when(F.col("availability"), 1.0).otherwise(0.0)
        total = total + weight("availability") * flag
    if preset.recency:
        span = F.nullif(F.date_diff(top["newest"], top["oldest"]), F.lit(0))
        age = F.date_diff(top["newest"], F.col("updated_at"))
        total = total + weight("recency") * F.coalesce(F.lit(1.0) - age / span, F.lit(0.0))
    return df.withColumn("_score", total if preset.decimals is None else F.round(total, preset.decimals))


def best(df: DataFrame, by: str, k: int, tie: str = "product_id") -> DataFrame:
    return df.orderBy(F.desc(by), F.asc(tie)).limit(k)


def top_k(
    df: DataFrame, k: int = 10, preset: ScorePreset = MAIN, weights: dict[str, float] | None = None
) -> DataFrame:
    return best(score(df, preset, weights), "_score", k)


def filter_products(df: DataFrame, max_price: float | None = None, category: str | None = None) -> DataFrame:
    """Price in [0, max_price] and, when given, one category."""
    if max_price is not None:
        df = df.where((F.col("price") >= 0) & (F.col("price") <= max_price))
    if category is not None:
        df = df.where(F.col("category") == category)
    return df


def popularity() -> Column:
    return F.coalesce("rating", F.lit(0.0)) * F.coalesce("reviews_count", F.lit(0))


def top_per_key(
    df: DataFrame, order_by: Sequence[Column], n: int, keys: Sequence[str] = ("category",), name: str = "rank"
) -> DataFrame:
    """First ``n`` rows per key; Spark keeps only ``n`` rows per key and partition before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)


def top_per_category(df: DataFrame, n: int = 5) -> DataFrame:
    scored = df.withColumn("popularity", popularity())
    return top_per_key(scored, [F.desc("popularity"), F.asc("product_id")], n)


def category_rank(df: DataFrame, by: str = "popularity") -> DataFrame:
    """Rank of every product in its category, safe for a category that holds most rows."""
    return (
        number_rows(df, [F.desc(by), F.asc("product_id")], ["category"], name="_pos")
        .withColumn("category_rank", F.col("_pos") + 1)
        .drop("_pos", "_total")
    )


def rank_limited(df: DataFrame, by: str, k: int, tie: str = "product_id") -> DataFrame:
    """Top ``k`` with a 1-based rank; the rank window only ever sees those ``k`` rows."""
    w = Window.orderBy(F.desc(by), F.asc(tie))
    return best(df, by, k, tie).withColumn("rank", F.row_number().over(w))


def rating_extremes(df: DataFrame, n_high: int = 5, n_low: int = 10) -> DataFrame:
    rated = df.where(F.col("rating").isNotNull())
    high = rated.orderBy(F.desc("rating"), F.asc("product_id")).limit(n_high)
    low = rated.orderBy(F.asc("rating"), F.asc("product_id")).limit(n_low)
    return high.withColumn("side", F.lit("highest")).unionByName(low.withColumn("side", F.lit("lowest")))
