"""Queries over the monthly price history."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import forecast, trend
from shelfwise.plans.catalog import HISTORY_SQL, PRODUCTS_SQL, held, price_history, products, table
from shelfwise.plans.registry import query

TAIL = """, tail AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY month DESC) AS back FROM series) WHERE back <= 100),
fit AS (SELECT category, count(*) AS n, regr_slope(price, -back) AS slope, avg(price) AS mean, min(price) AS low, arg_max(price, month) AS current_price,
  regr_sxx(price, -back) AS sxx, regr_syy(price, -back) AS syy, regr_sxy(price, -back) AS sxy FROM tail GROUP BY category)
"""
TREND_SQL = """CASE WHEN n < 5 THEN 'insufficient_data' WHEN slope / (mean + 1e-6) > 0.015 THEN 'growing' WHEN slope / (mean + 1e-6) < -0.015 THEN 'declining' ELSE 'stable' END"""
BY_CATEGORY = ", series AS (SELECT * FROM history)"
OVERALL = """, series AS (SELECT 'all' AS category, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, avg(l_extendedprice / l_quantity) AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 2)"""


@query("price_history_tail", HISTORY_SQL + BY_CATEGORY + TAIL + "SELECT category, month, round(price, 6) AS price FROM tail WHERE back <= 30")
def price_history_tail(spark, sf):
    tail = trend.history_tail(price_history(spark, sf), ["category"], "month", 30)
    return tail.select("category", "month", F.round("price", 6).alias("price"))


@query(
    "price_trend",
    HISTORY_SQL + OVERALL + TAIL + f"SELECT n, {TREND_SQL} AS trend, round(slope, 6) AS slope, round(slope / (mean + 1e-6), 6) AS normalized_slope, round(current_price, 6) AS current_price, round(mean, 6) AS avg_price FROM fit",
)
def price_trend(spark, sf):
    line, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    series = (
        line.join(orders, line.l_orderkey == orders.o_orderkey)
        .groupBy(F.to_date(F.date_trunc("month", "o_orderdate")).alias("month"))
        .agg(F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
    )
    return _rounded(trend.price_trend(series, [], "month"))


def _rounded(df):
    cols = ("slope", "normalized_slope", "current_price", "avg_price")
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query(
    "category_price_trend",
    HISTORY_SQL + BY_CATEGORY + TAIL + f"SELECT category, n, {TREND_SQL} AS trend, round(slope, 6) AS slope, round(slope / (mean + 1e-6), 6) AS normalized_slope, round(current_price, 6) AS current_price, round(mean, 6) AS avg_price FROM fit",
)
def category_price_trend(spark, sf):
    return _rounded(trend.price_trend(price_history(spark, sf), ["category"], "month"))


FORECAST = """, f AS (SELECT fit.*, CAST(step AS INTEGER) AS step, mean + slope * (n - 1) / CAST(2 AS DOUBLE) + greatest(slope, -(mean * CAST(0.1 AS DOUBLE)) / 30) * step AS point,
      CAST(1.96 AS DOUBLE) * sqrt(greatest(syy - slope * sxy, 0) / (n - 2)) * sqrt(1 + CAST(1 AS DOUBLE) / n + ((n - 1) / CAST(2 AS DOUBLE) + step) * ((n - 1) / CAST(2 AS DOUBLE) + step) / sxx) AS spread
      FROM fit, range(1, 31) r(step) WHERE n >= 5)
"""


@query(
    "price_forecast",
    HISTORY_SQL + BY_CATEGORY + TAIL + FORECAST + """
    SELECT category, step, round(least(greatest(point, low), 2 * mean), 4) AS forecast, round(least(greatest(point - spread, low), 2 * mean), 4) AS lower,
      round(least(greatest(point + spread, low), 2 * mean), 4) AS upper FROM f""",
)
def price_forecast(spark, sf):
    forecast = trend.price_forecast(price_history(spark, sf), ["category"], "month")
    return forecast.withColumns({c: F.round(c, 4) for c in ("forecast", "lower", "upper")})


@query(
    "price_forecast_line",
    HISTORY_SQL + BY_CATEGORY + TAIL + FORECAST + """
    SELECT category, step, round(least(greatest(point, low), 2 * mean), 4) AS forecast, round(least(greatest(point - spread, low), 2 * mean), 4) AS lower,
      round(least(greatest(point + spread, low), 2 * mean), 4) AS upper FROM f""",
)
def price_forecast_line(spark, sf):
    """The seasonal fit with neither season nor bends: the straight line."""
    found = forecast.seasonal_forecast(price_history(spark, sf), ["category"], "month", harmonics=0, breaks=0)
    return found.select("category", "step", *[F.round(c, 4).alias(c) for c in ("forecast", "lower", "upper")])


@query("price_forecast_seasonal")
def price_forecast_seasonal(spark, sf):
    """Monthly prices with a yearly season and four places where the trend may bend."""
    return forecast.seasonal_forecast(price_history(spark, sf), ["category"], "month")


POPULARITY = """, i AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY month) AS i FROM history),
pop AS (SELECT category, count(*) AS n, regr_slope(reviews, i) AS rs, regr_slope(rating, i) AS gs, sum(reviews) AS total_reviews, avg(rating) AS avg_rating FROM i GROUP BY category),
popular AS (SELECT category, CASE WHEN n < 5 THEN 'insufficient_data' WHEN rs > 2 THEN 'increasing' WHEN rs < -2 THEN 'decreasing' ELSE 'stable' END AS review_trend,
  CASE WHEN n < 5 THEN 'insufficient_data' WHEN gs > 0.04 THEN 'improving' WHEN gs < -0.04 THEN 'declining' ELSE 'stable' END AS rating_trend,
  round(rs, 6) AS review_slope, round(gs, 6) AS rating_slope, total_reviews, round(avg_rating, 6) AS avg_rating FROM pop)
"""


@query("popularity_trend", HISTORY_SQL + POPULARITY + "SELECT * FROM popular")
def popularity_trend(spark, sf):
    found = trend.popularity_trend(price_history(spark, sf), ["category"], "month")
    return found.withColumns({c: F.round(c, 6) for c in ("review_slope", "rating_slope", "avg_rating")})


@query(
    "price_change",
    HISTORY_SQL + """SELECT category, month, round(price - lag(price) OVER w, 6) AS price_change, round(rating - lag(rating) OVER w, 6) AS rating_change
    FROM history WINDOW w AS (PARTITION BY category ORDER BY month)""",
)
def price_change(spark, sf):
    changed = trend.value_change(price_history(spark, sf), ["category"], "month", ["price", "rating"])
    return changed.select("category", "month", *[F.round(c, 6).alias(c) for c in ("price_change", "rating_change")])


@query(
    "trend_insights",
    HISTORY_SQL + BY_CATEGORY + TAIL + FORECAST + POPULARITY + PRODUCTS_SQL.strip().replace("WITH facts AS", ", facts AS") + f""",
    st AS (SELECT category, count(price) AS n, avg(rating) AS r FROM products WHERE category IS NOT NULL GROUP BY 1)
    SELECT 'total_products' AS section, 'all' AS item, CAST(count(*) AS VARCHAR) AS value FROM products
    UNION ALL SELECT 'price_trend', category, {TREND_SQL} FROM fit
    UNION ALL SELECT 'price_forecast', category || '/' || step, concat_ws(' ', CAST(CAST(round(least(greatest(point, low), 2 * mean), 2) AS DECIMAL(18, 2)) AS VARCHAR),
      CAST(CAST(round(least(greatest(point - spread, low), 2 * mean), 2) AS DECIMAL(18, 2)) AS VARCHAR), CAST(CAST(round(least(greatest(point + spread, low), 2 * mean), 2) AS DECIMAL(18, 2)) AS VARCHAR)) FROM f
    UNION ALL SELECT 'review_trend', category, review_trend FROM popular
    UNION ALL SELECT 'rating_trend', category, rating_trend FROM popular
    UNION ALL SELECT 'category_trend', category, 'rising' FROM (SELECT category FROM st WHERE n > (SELECT avg(n) FROM st) * 1.3 OR r > 4.2 ORDER BY category LIMIT 6)
    UNION ALL SELECT 'category_trend', category, 'declining' FROM (SELECT category FROM st WHERE n < (SELECT avg(n) FROM st) * 0.6 AND r < 3.5 ORDER BY category LIMIT 6)""",
)
def trend_insights(spark, sf):
    return trend.insight_rows(trend.trend_insights(held(products(spark, sf), "category", "price", "rating", "reviews_count"), held(price_history(spark, sf))))
