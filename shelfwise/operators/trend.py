"""Price and popularity trends, forecasts and history tails over time series."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.ordering import number_rows, previous_values
from shelfwise.operators.aggregate import category_movers
from shelfwise.operators.model import trending_products
from shelfwise.operators.scoring import top_per_key

MIN_POINTS = 5
LOOKBACK = 100
PRICE_BAND = 0.015
HORIZON = 30


def history_tail(df: DataFrame, keys: Sequence[str], ts: str, n: int = 30) -> DataFrame:
    """Last ``n`` observations per series; ``_back`` is 1 for the newest."""
    if not keys:
        newest = df.orderBy(F.desc(ts)).limit(n)
        return newest.withColumn("_back", F.row_number().over(Window.orderBy(F.desc(ts))))
    return top_per_key(df, [F.desc(ts)], n, keys, name="_back")


def _fit(df: DataFrame, keys: Sequence[str], ts: str, value: str, last: int) -> DataFrame:
    """Least squares of the last observations on their index (0 = oldest kept)."""
    tail = history_tail(df.where(F.col(value).isNotNull()), keys, ts, last)
    x, y = -F.col("_back").cast("double"), F.col(value).cast("double")
    return tail.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.avg(y).alias("mean"),
        F.min(y).alias("low"),
        F.max_by(y, F.col(ts)).alias("current"),
        F.regr_sxx(y, x).alias("sxx"),
        F.regr_syy(y, x).alias("syy"),
        F.regr_sxy(y, x).alias("sxy"),
    )


def _direction(normalised: Column, enough: Column) -> Column:
    return (
        F.when(~enough, "insufficient_data")
        .when(normalised > PRICE_BAND, "growing")
        .when(normalised < -PRICE_BAND, "declining")
        .otherwise("stable")
    )


def price_trend(df: DataFrame, keys: Sequence[str], ts: str, value: str = "price", last: int = LOOKBACK) -> DataFrame:
    """Slope, slope relative to the mean and direction per series."""
    fit = _fit(df, keys, ts, value, last)
    enough = F.col("n") >= MIN_POINTS
    slope = F.when(enough, F.col("slope")).otherwise(0.0)
    normalised = slope / (F.col("mean") + F.lit(1e-6))
    return fit.select(
        *keys,
        "n",
        _direction(normalised, enough).alias("trend"),
        slope.alias("slope"),
        F.when(enough, normalised).alias("normalized_slope"),
        F.when(enough, F.col("current")).alias("current_price"),
        F.when(enough, F.col("mean")).alias("avg_price"),
    )


def price_forecast(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str = "price",
    horizon: int = HORIZON,
    last: int = LOOKBACK,
) -> DataFrame:
    """Linear forecast with a 95 % prediction band, one row per series and step.

    The slope may not fall below -10 % of the mean per 30 steps; values stay
    between the lowest observation and twice the mean.
    """
    fit = _fit(df, keys, ts, value, last).where(F.col("n") >= MIN_POINTS)
    n, mean = F.col("n"), F.col("mean")
    slope = F.greatest(F.col("slope"), -(mean * F.lit(0.10)) / F.lit(30.0))
    end = mean + F.col("slope") * (n - 1) / F.lit(2.0)
    residual = F.sqrt(F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0)) / (n - 2))
    ahead = (n - 1) / F.lit(2.0) + F.col("step")
    spread = F.lit(1.96) * residual * F.sqrt(F.lit(1.0) + F.lit(1.0) / n + ahead * ahead / F.col("sxx"))

    def clamp(c: Column) -> Column:
        return F.least(F.greatest(c, F.col("low")), F.lit(2.0) * mean)

    steps = fit.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    point = end + slope * F.col("step")
    return steps.select(
        *keys,
        "step",
        clamp(point).alias("forecast"),
        clamp(point - spread).alias("lower"),
        clamp(point + spread).alias("upper"),
    )


def forecast_with(
    df: DataFrame, keys: Sequence[str], ts: str, model: Callable, schema: str, value: str = "price", last: int = LOOKBACK
) -> DataFrame:
    """Run a user model per series on its last observations (bounded by ``last``)."""
    tail = history_tail(df, keys, ts, last).select(*keys, ts, value)
    return tail.groupBy(*keys).applyInPandas(model, schema)


def popularity_trend(
    df: DataFrame, keys: Sequence[str], ts: str, reviews: str = "reviews", rating: str = "rating"
) -> DataFrame:
    """Review and rating direction per series from the slopes on the time index."""
    series = df.select(*keys, ts, reviews, rating)
    indexed = number_rows(series, [F.col(ts)], keys, name="_i").withColumn("_i", F.col("_i").cast("double"))
    agg = indexed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope(F.col(reviews).cast("double"), F.col("_i")).alias("rs"),
        F.regr_slope(F.col(rating).cast("double"), F.col("_i")).alias("gs"),
        F.sum(reviews).alias("total_reviews"),
        F.avg(rating).alias("avg_rating"),
    )
    enough = F.col("n") >= MIN_POINTS

    def label(slope: str, limit: float, up: str, down: str) -> Column:
        return (
            F.when(~enough, "insufficient_data")
            .when(F.col(slope) > limit, up)
            .when(F.col(slope) < -limit, down)
            .otherwise("stable")
        )

    return agg.select(
        *keys,
        label("rs", 2.0, "increasing", "decreasing").alias("review_trend"),
        label("gs", 0.04, "improving", "declining").alias("rating_trend"),
        F.when(enough, F.col("rs")).alias("review_slope"),
        F.when(enough, F.col("gs")).alias("rating_slope"),
        "total_reviews",
        "avg_rating",
    )


def value_change(df: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str]) -> DataFrame:
    """Difference of each value to the previous observation of its series; ``ts`` is unique within a series."""
    placed = previous_values(df, [F.col(ts)], values, keys)
    changes = {f"{v}_change": F.col(v) - F.col(f"{v}_previous") for v in values}
    return placed.withColumns(changes).drop(*[f"{v}_previous" for v in values])


def trend_insights(
    products: DataFrame, history: DataFrame, key: str = "category", ts: str = "month", trending: bool = False
) -> dict[str, DataFrame]:
    """The trend report as one DataFrame per section; ``trending`` also fits the trending model."""
    sections = {} if not trending else {"trending_products": trending_products(products)}
    return sections | {
        "price_trend": price_trend(history, [key], ts),
        "price_forecast": price_forecast(history, [key], ts),
        "popularity_trend": popularity_trend(history, [key], ts),
        "category_movers": category_movers(products),
        "totals": products.agg(F.count(F.lit(1)).alias("total_products")),
    }


def insight_rows(sections: dict[str, DataFrame], key: str = "category") -> DataFrame:
    """The report flattened to (section, item, value) rows; a forecast's item is its series and step."""

    def rows(section: str, df: DataFrame, item: Column, value: Column) -> DataFrame:
        return df.select(F.lit(section).alias("section"), item.cast("string").alias("item"), value.cast("string").alias("value"))

    def money(c: str) -> Column:
        return F.round(c, 2).cast("decimal(18,2)").cast("string")

    series, popular = F.col(key), sections["popularity_trend"]
    band = F.concat_ws(" ", money("forecast"), money("lower"), money("upper"))
    parts = [
        rows("total_products", sections["totals"], F.lit("all"), F.col("total_products")),
        rows("price_trend", sections["price_trend"], series, F.col("trend")),
        rows("price_forecast", sections["price_forecast"], F.concat_ws("/", series, F.col("step").cast("string")), band),
        rows("review_trend", popular, series, F.col("review_trend")),
        rows("rating_trend", popular, series, F.col("rating_trend")),
        rows("category_trend", sections["category_movers"], F.col("category"), F.col("direction")),
    ]
    if "trending_products" in sections:
        parts.append(rows("trending_products", sections["trending_products"], F.col("product_id"), F.col("score")))
    return reduce(DataFrame.unionByName, parts)
