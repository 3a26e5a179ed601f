import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import aggregate, trend


def series(spark, values, key="a"):
    rows = [(key, i, float(v), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, ts int, price double, rating double").repartition(3)


@pytest.mark.parametrize(
    "values,slope,normalised,name",
    [
        ([10, 11, 12, 13, 14, 15], 1, 0.08, "growing"),
        ([15, 14, 13, 12, 11, 10], -1, -0.08, "declining"),
        ([100] * 5, 0, 0, "stable"),
    ],
)
def test_price_trend(spark, values, slope, normalised, name):
    for keys in (["k"], []):
        r = trend.price_trend(series(spark, values), keys, "ts").first()
        assert r.trend == name
        assert r.slope == pytest.approx(slope, abs=1e-9)
        assert r.normalized_slope == pytest.approx(normalised, abs=1e-6)
        assert r.current_price == values[-1]


def test_too_short(spark):
    r = trend.price_trend(series(spark, [1, 2, 3, 4]), ["k"], "ts").first()
    assert (r.trend, r.slope) == ("insufficient_data", 0.0)
    assert trend.price_forecast(series(spark, [1, 2, 3, 4]), ["k"], "ts").count() == 0


def test_only_last_observations_count(spark):
    values = [1000.0] * 50 + [float(i) for i in range(1, 101)]
    r = trend.price_trend(series(spark, values), ["k"], "ts").first()
    assert (r.n, r.slope) == (100, pytest.approx(1.0))
    assert trend.history_tail(series(spark, values), ["k"], "ts", 30).agg(F.min("ts")).first()[0] == 120


def test_popularity(spark):
    def labels(values):
        r = trend.popularity_trend(series(spark, values), ["k"], "ts", "price", "rating").first()
        return r.review_trend, r.rating_trend

    assert labels([10, 12, 14, 16, 18])[0] == "stable"  # slope 2 is not above 2
    assert labels([10, 13, 16, 19, 22])[0] == "increasing"
    assert labels([4.0, 4.05, 4.1, 4.15, 4.2])[1] == "improving"
    assert labels([1, 2, 3, 4]) == ("insufficient_data", "insufficient_data")


def test_forecast(spark):
    values = [10 + i + (-1) ** i * 0.5 for i in range(12)]
    rows = {r.step: r for r in trend.price_forecast(series(spark, values), ["k"], "ts").collect()}
    assert len(rows) == 30
    x = np.arange(12)
    slope, start = np.polyfit(x, values, 1)
    residual = np.sqrt(((values - (slope * x + start)) ** 2).sum() / 10)
    ahead = 11 + 3 - x.mean()
    spread = 1.96 * residual * np.sqrt(1 + 1 / 12 + ahead**2 / ((x - x.mean()) ** 2).sum())
    point = start + slope * 14
    assert (rows[3].forecast, rows[3].lower, rows[3].upper) == pytest.approx((point, point - spread, point + spread))
    assert rows[30].upper == pytest.approx(2 * np.mean(values))  # cap


def test_forecast_decline_is_limited(spark):
    values = [100.0, 90.0, 80.0, 70.0, 60.0]
    rows = {r.step: r.forecast for r in trend.price_forecast(series(spark, values), ["k"], "ts").collect()}
    assert rows[1] == 60.0  # the floor is the lowest observation
    up = trend.price_forecast(series(spark, [60.0, 100.0, 90.0, 80.0, 99.0]), ["k"], "ts").collect()
    assert all(60.0 <= r.lower <= r.forecast <= r.upper for r in up)


def test_user_model(spark):
    def last(pdf):
        return pdf.sort_values("ts").tail(1)[["k", "price"]]

    assert trend.forecast_with(series(spark, [1, 2, 3]), ["k"], "ts", last, "k string, price double").first().price == 3.0


def test_movers(spark):
    rows = [("big", 1.0, 3.0, 1)] * 20 + [("good", 1.0, 4.5, 1)] * 3 + [("poor", 1.0, 2.0, 1)] * 2
    df = spark.createDataFrame(rows, "category string, price double, rating double, reviews_count int")
    got = {(r.direction, r.category) for r in aggregate.category_movers(df).collect()}
    assert got == {("rising", "big"), ("rising", "good"), ("declining", "poor")}


def test_histogram(spark):
    df = spark.createDataFrame([(0.05,), (0.3,), (3.0,), (70.0,), (None,)], "v double")
    rows = aggregate.duration_histogram(df, "v", (0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0)).collect()
    assert [r.n for r in rows] == [1, 2, 2, 2, 3, 3, 3, 3, 4]
    assert rows[0].total_sum == pytest.approx(73.35)


def test_sessions_with_a_busy_entity(spark):
    rows = [("busy", 1_700_000_000 + i) for i in range(0, 4000, 7)] + [("busy", 1_700_010_000), ("calm", 5), ("calm", 100), ("calm", 160)]
    df = spark.createDataFrame(rows, "e string, s bigint").select("e", F.timestamp_seconds("s").alias("ts")).repartition(4)
    got = sorted((r.e, r.n) for r in aggregate.sessions(df, "e", "ts", 60).collect())
    # 60 s of silence is a new session
    assert got == sorted([("busy", 572), ("busy", 1), ("calm", 1), ("calm", 1), ("calm", 1)])
    assert sorted(r.n for r in aggregate.sessions(df.where("e = 'calm'"), "e", "ts", 61).collect()) == [1, 2]
