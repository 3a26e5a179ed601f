"""Category comparison, emerging products, market segments and text briefs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.scoring import best, rank_limited, top_per_category

# fixed values: names given to a missing category and vendor
UNKNOWN = "Unknown"


def compare_products(df: DataFrame, n: int = 5) -> DataFrame:
    """Leaders per category with their price range and rating; single-product categories left out.

    The list of names is gathered over at most ``n`` leaders per category.
    """
    sizes = df.groupBy("category").agg(F.count(F.lit(1)).alias("category_size"))
    leaders = top_per_category(df, n)
    price = F.coalesce("price", F.lit(0.0))
    compared = leaders.groupBy("category").agg(
        F.count(F.lit(1)).alias("products_compared"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("rank", "name"))), lambda s: s["name"]), ", "
        ).alias("product_names"),
        F.round(F.min(price), 2).alias("min_price"),
        F.round(F.max(price), 2).alias("max_price"),
        F.round(F.avg(price), 2).alias("avg_price"),
        F.round(F.avg(F.coalesce("rating", F.lit(0.0))), 2).alias("avg_rating"),
    )
    return compared.join(
        sizes.where(F.col("category_size") >= 2).withColumnRenamed("category", "_c"),
        F.col("category").eqNullSafe(F.col("_c")),
    ).drop("_c")


def emergence_score(df: DataFrame) -> DataFrame:
    rating, reviews = F.coalesce("rating", F.lit(0.0)), F.coalesce("reviews_count", F.lit(0))
    price = F.coalesce("price", F.lit(0.0))
    total = (
        (rating / F.lit(5.0)) * F.lit(0.35)
        + F.least(reviews / F.lit(500.0), F.lit(1.0)) * F.lit(0.35)
        + (F.lit(1.0) - F.least(price / F.lit(200.0), F.lit(1.0))) * F.lit(0.20)
        + F.when(F.col("availability"), 1.0).otherwise(0.0) * F.lit(0.10)
    )
    return df.withColumn("emergence_score", F.round(total, 4))


def emerging_products(df: DataFrame, k: int = 10) -> DataFrame:
    return rank_limited(emergence_score(df), "emergence_score", k)


def segments(df: DataFrame, k: int = 8) -> DataFrame:
    """Categories by value: average rating against average price; NULL category is one group."""
    agg = df.groupBy("category").agg(
        F.count(F.lit(1)).alias("product_count"),
        F.avg(F.coalesce("price", F.lit(0.0))).alias("p"),
        F.avg(F.coalesce("rating", F.lit(0.0))).alias("r"),
        F.count_if(~F.coalesce("availability", F.lit(True))).alias("out_of_stock"),
    )
    scored = agg.select(
        "category",
        "product_count",
        F.round("p", 2).alias("avg_price"),
        F.round("r", 2).alias("avg_rating"),
        "out_of_stock",
        F.round(F.col("r") / (F.col("p") / F.lit(10.0) + F.lit(1.0)), 4).alias("value_score"),
    )
    return best(scored, "value_score", k, tie="category")


def market_context(df: DataFrame) -> DataFrame:
    price, rating = F.coalesce("price", F.lit(0.0)), F.coalesce("rating", F.lit(0.0))
    return df.agg(
        F.count(F.lit(1)).alias("products"),
        F.avg(price).alias("avg_price"),
        F.avg(rating).alias("avg_rating"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
    )


def product_lines(df: DataFrame) -> DataFrame:
    """One text line per ranked product."""
    # fixed values: the labels and their order
    line = F.concat(
        F.col("rank").cast("string"),
        F.lit(". "),
        F.coalesce("name", F.lit(UNKNOWN)),
        F.lit(" | Vendeur: "),
        F.coalesce("vendor", F.lit(UNKNOWN)),
        F.lit(" | Prix: "),
        F.format_string("%.2f", F.round(F.coalesce("price", F.lit(0.0)), 2)),
        F.lit("$ | Note: "),
        F.format_string("%.2f", F.round(F.coalesce("rating", F.lit(0.0)), 2)),
        F.lit("/5 | Avis: "),
        F.coalesce("reviews_count", F.lit(0)).cast("string"),
        F.lit(" | Disponible: "),
        F.when(F.col("availability"), "Oui").otherwise("Non"),
    )
    return df.withColumn("line", line)


def category_brief(df: DataFrame, n: int = 5) -> DataFrame:
    """Leaders of each category as one short document (``n`` lines at most)."""
    lines = product_lines(top_per_category(df, n))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("rank", "line"))), lambda s: s["line"])
    return lines.groupBy("category").agg(F.array_join(ordered, "\n").alias("brief"))


def context_lines(df: DataFrame, n: int = 50) -> DataFrame:
    """First ``n`` products by price as chat context lines, in order."""
    top = best(df, "price", n)
    position = F.row_number().over(Window.orderBy(F.desc("price"), "product_id"))
    return top.select(
        position.alias("position"),
        F.format_string("- %s | %.0f$", F.coalesce("name", F.lit("?")), F.round(F.coalesce("price", F.lit(0.0)), 0)).alias("line"),
    )


def summary_prompt(text: str = "text") -> Column:
    """Text-to-summarise wrapper around a text column."""
    # fixed value: the wording of the request
    return F.concat(F.lit("Summarize the following text in 3-4 concise sentences:\n\n"), F.col(text))


ANALYSES = {
    "comparison": compare_products,
    "emerging": emerging_products,
    "recommendations": segments,
}
MIN_PRODUCTS = {"comparison": 2, "emerging": 1, "recommendations": 1}


def competitive_analysis(df: DataFrame, analysis_type: str = "full") -> dict[str, DataFrame]:
    """The chosen analysis plus a status row for each; any other type means all of them."""
    chosen = {analysis_type: ANALYSES[analysis_type]} if analysis_type in ANALYSES else ANALYSES
    out = {name: run(df) for name, run in chosen.items()}
    out["status"] = analysis_status(df).where(F.col("analysis").isin(*chosen))
    return out


def analysis_status(df: DataFrame) -> DataFrame:
    """``completed``, ``insufficient_data`` or ``no_data`` per analysis, from one count."""
    needs = F.array(*[F.struct(F.lit(a).alias("analysis"), F.lit(m).alias("needs")) for a, m in MIN_PRODUCTS.items()])
    counted = df.agg(F.count(F.lit(1)).alias("products")).select("products", F.explode(needs).alias("a"))
    status = (
        F.when(F.col("products") == 0, "no_data")
        .when(F.col("products") < F.col("a.needs"), "insufficient_data")
        .otherwise("completed")
    )
    return counted.select("a.analysis", "products", status.alias("status"))


def vendor_ranking(df: DataFrame) -> DataFrame:
    """Vendors with country, size, mean score and their best product by score.

    Scores carry four decimals; summed as whole ten-thousandths their mean does
    not depend on the order of addition.
    """
    flagship = F.max(F.struct(F.col("_score"), F.col("product_id"), F.col("name")))
    return (
        df.where(F.col("vendor").isNotNull())
        .groupBy("vendor", "country")
        .agg(
            F.count(F.lit(1)).alias("products"),
            (F.sum(F.round(F.col("_score") * 10000)) / F.count("_score") / 10000).alias("avg_score"),
            F.avg("rating").alias("avg_rating"),
            flagship.alias("_f"),
        )
        .select("vendor", "country", "products", "avg_score", "avg_rating", F.col("_f.name").alias("flagship"), F.col("_f._score").alias("flagship_score"))
    )
