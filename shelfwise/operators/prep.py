"""Cleaning, imputation, scaling, encoding and feature columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import or_zero, parse_flag, price_band, seeded_draw
from shelfwise.functions.ordering import number_rows, quantiles
from shelfwise.session import broadcast_if_small

FEATURES = ("price", "rating", "reviews_count", "quantity")
NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def scalars(df: DataFrame, **aggregates: Column) -> Column:
    """One-row aggregate of ``df`` as a struct-valued scalar subquery.

    The struct is computed once however many of its fields a plan uses.
    """
    return df.agg(F.struct(*[c.alias(n) for n, c in aggregates.items()]).alias("s")).scalar()


def coerce_types(
    df: DataFrame,
    numeric: Sequence[str] = ("price", "rating", "reviews_count"),
    flags: Sequence[str] = ("availability",),
) -> DataFrame:
    """Bad or missing numbers become 0, flags are true only for true/1/yes."""
    return df.withColumns({c: or_zero(c) for c in numeric} | {c: parse_flag(c) for c in flags})


def numeric_frame(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The named columns, or every numeric one, as doubles with 0 for bad cells."""
    if columns is None:
        columns = [n for n, t in df.dtypes if t in NUMERIC_TYPES or t.startswith("decimal")]
    return df.select(*[or_zero(c).alias(c) for c in columns])


def null_profile(df: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Non-null count per column and whether the column survives the sparsity rule."""
    counted = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"c_{i}") for i, c in enumerate(df.columns)])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"c_{i}").alias("non_null")) for i, c in enumerate(df.columns)]
    )
    needed = F.floor(F.col("n") * F.lit(1 - threshold))
    return counted.select("n", F.explode(pairs).alias("p")).select(
        "p.column_name",
        "p.non_null",
        (F.col("p.non_null") >= needed).alias("kept"),
    )


def drop_sparse(df: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Keep columns with at least ``int(n * (1 - threshold))`` non-null cells (one pass, one row back)."""
    kept = {r.column_name for r in null_profile(df, threshold).where("kept").collect()}
    return df.select(*[c for c in df.columns if c in kept])


def fill_missing(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Price takes the median; rating, reviews and quantity 0; availability false."""
    median = quantiles(df, "price", {"median": 0.5}, approximate=approximate).scalar()
    return df.withColumn("price", F.coalesce("price", median)).fillna(
        {"rating": 0.0, "reviews_count": 0, "quantity": 0, "availability": False}
    )


def fill_zero(df: DataFrame, columns: Sequence[str] = ("price", "rating", "reviews_count")) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(t)) for c, t in df.dtypes if c in columns})


def zscore(
    df: DataFrame,
    columns: Sequence[str],
    suffix: str = "_norm",
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Population z-score; a constant column gives 0.  ``fit_on`` supplies the statistics."""
    aggregates = {}
    for c in columns:
        aggregates |= {f"m_{c}": F.avg(F.col(c).cast("double")), f"s_{c}": F.stddev_pop(F.col(c).cast("double"))}
    stats = scalars(fit_on if fit_on is not None else df, **aggregates)
    return df.withColumns(
        {
            c + suffix: F.when(stats[f"s_{c}"] > 0, (F.col(c) - stats[f"m_{c}"]) / stats[f"s_{c}"]).when(
                F.col(c).isNotNull(), 0.0
            )
            for c in columns
        }
    )


def minmax_scale(df: DataFrame, columns: Sequence[str], suffix: str = "_minmax") -> DataFrame:
    aggregates = {}
    for c in columns:
        aggregates |= {f"lo_{c}": F.min(c), f"hi_{c}": F.max(c)}
    s = scalars(df, **aggregates)
    return df.withColumns(
        {
            c + suffix: F.coalesce(
                (F.col(c) - s[f"lo_{c}"]) / F.nullif(s[f"hi_{c}"] - s[f"lo_{c}"], F.lit(0)),
                F.when(F.col(c).isNotNull(), 0.0),
            )
            for c in columns
        }
    )


def robust_scale(df: DataFrame, column: str, suffix: str = "_robust", approximate: bool = False) -> DataFrame:
    """(x - median) / IQR; a zero IQR gives 0."""
    q = quantiles(df, column, {"q1": 0.25, "q2": 0.5, "q3": 0.75}, approximate=approximate)
    s = q.select(F.struct("q1", "q2", "q3")).scalar()
    scaled = (F.col(column) - s["q2"]) / F.nullif(s["q3"] - s["q1"], F.lit(0))
    return df.withColumn(column + suffix, F.coalesce(scaled, F.when(F.col(column).isNotNull(), 0.0)))


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """Distinct values in alphabetical order with codes from 0; NULL counts as the text ``None``."""
    values = df.select(F.coalesce(F.col(column), F.lit("None")).alias(column)).distinct()
    return number_rows(values, [F.col(column)], name=f"{column}_encoded").drop("_total")


def label_encode(df: DataFrame, columns: Sequence[str] = ("category", "vendor")) -> DataFrame:
    for c in columns:
        codes = broadcast_if_small(label_codes(df, c).withColumnRenamed(c, "_label"))
        df = df.join(codes, F.coalesce(F.col(c), F.lit("None")) == F.col("_label"), "left").drop("_label")
    return df


def with_price_category(df: DataFrame) -> DataFrame:
    return df.withColumn("price_category", price_band("price"))


def discount_pct(price: str = "price", compare_at: str = "compare_at_price") -> Column:
    """Percent off the comparison price, NULL without one."""
    return F.when(
        F.col(compare_at) > 0, (F.col(compare_at) - F.col(price)) / F.col(compare_at) * F.lit(100.0)
    )


def keep_originals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({f"{c}_original": F.col(c) for c in columns})


def quality_score(df: DataFrame) -> DataFrame:
    """0.6 * rating/5 + 0.4 * reviews / max(reviews), with a zero maximum read as 1."""
    top = F.coalesce(F.nullif(scalars(df, m=F.max("reviews_count"))["m"], F.lit(0)), F.lit(1))
    return df.withColumn(
        "quality_score",
        F.lit(0.6) * (F.coalesce("rating", F.lit(0.0)) / F.lit(5.0))
        + F.lit(0.4) * (F.coalesce("reviews_count", F.lit(0)) / top),
    )


def flag_top_quartile(df: DataFrame, score: str = "quality_score", approximate: bool = False) -> DataFrame:
    edge = quantiles(df, score, {"q": 0.75}, approximate=approximate).scalar()
    return df.withColumn("is_top", (F.col(score) >= edge).cast("int"))


def feature_columns(
    df: DataFrame, features: Sequence[str] = FEATURES, label: str | None = None
) -> DataFrame:
    """Features as doubles (bad cells 0), rows without a label dropped."""
    if label is not None:
        df = df.where(F.col(label).isNotNull())
    return df.withColumns({c: or_zero(c) if c in df.columns else F.lit(0.0) for c in features})


def feature_matrix(
    df: DataFrame, features: Sequence[str] = FEATURES, label: str | None = None, output: str = "features"
) -> DataFrame:
    assembler = VectorAssembler(inputCols=list(features), outputCol=output)
    return assembler.transform(feature_columns(df, features, label))


VENDOR_POOL = ("Generic Brand", "TechCo", "HomeGoods", "FashionWear", "SportMax")  # fixed values
TAG_POOL = (  # fixed values
    ("gadget", "tech"),
    ("fashion", "apparel"),
    ("home", "decor"),
    ("sports", "fitness"),
    ("beauty", "care"),
)


def impute_missing(
    df: DataFrame,
    seed: int = 42,
    rating_bounds: tuple[float, float] = (0.5, 5.0),
    max_reviews: int = 200,
    max_quantity: int = 50,
    available_share: float = 0.7,
) -> DataFrame:
    """Fill missing cells from hashes of the product id.

    Ratings and review counts of 0 count as missing.  The draw depends on the id
    and the seed alone, so reruns and other partitionings give the same rows.
    """

    def pick(pool: Column, n: int, salt: str) -> Column:
        return F.get(pool, seeded_draw("product_id", salt, n, seed))

    lo, hi = (int(b * 10) for b in rating_bounds)
    drawn_rating = (F.lit(lo) + seeded_draw("product_id", "rating", hi - lo + 1, seed)) / F.lit(10.0)
    vendors = F.array(*[F.lit(v) for v in VENDOR_POOL])
    tags = F.array(*[F.array(*[F.lit(t) for t in pair]) for pair in TAG_POOL])
    return df.withColumns(
        {
            "availability": F.coalesce(
                "availability", seeded_draw("product_id", "availability", 1000, seed) < int(available_share * 1000)
            ),
            "quantity": F.coalesce("quantity", seeded_draw("product_id", "quantity", max_quantity + 1, seed)),
            "vendor": F.when(F.trim("vendor") != "", F.col("vendor")).otherwise(
                pick(vendors, len(VENDOR_POOL), "vendor")
            ),
            "rating": F.when(F.col("rating") != 0, F.col("rating")).otherwise(drawn_rating),
            "reviews_count": F.when(F.col("reviews_count") != 0, F.col("reviews_count")).otherwise(
                seeded_draw("product_id", "reviews", max_reviews, seed) + 1
            ),
            "tags": F.when(F.size("tags") > 0, F.col("tags")).otherwise(pick(tags, len(TAG_POOL), "tags")),
        }
    )


def missing_ratings(df: DataFrame) -> DataFrame:
    return df.where(F.col("rating").isNull() | (F.col("rating") == 0))


def price_outliers(df: DataFrame, keys: Sequence[str] = ("category",), fence: float = 1.5, z: float = 3.0) -> DataFrame:
    """Flag prices outside the per-key IQR fences or more than ``z`` deviations off the key mean.

    Ratings of the whole key are never gathered: fences come from exact
    distributed quantiles and are joined back on the key.
    """
    q = quantiles(df, "price", {"q1": 0.25, "q3": 0.75}, keys)
    m = df.groupBy(*keys).agg(F.avg("price").alias("m"), F.stddev_pop("price").alias("s"))
    bounds = broadcast_if_small(q.join(m, list(keys)))  # one row per key: the rows of a hot key stay where they are
    iqr = F.col("q3") - F.col("q1")
    return (
        df.join(bounds, list(keys))
        .withColumns(
            {
                "iqr_outlier": (F.col("price") < F.col("q1") - fence * iqr)
                | (F.col("price") > F.col("q3") + fence * iqr),
                "z_outlier": F.coalesce(F.abs(F.col("price") - F.col("m")) > z * F.nullif("s", F.lit(0.0)), F.lit(False)),
            }
        )
        .drop("m", "s")
    )
