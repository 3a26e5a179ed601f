import math
from datetime import date, timedelta

import numpy as np
import pytest

from shelfwise.operators import forecast, trend

DAY = date(2020, 1, 1)


def frame(spark, **series):
    rows = [(k, DAY + timedelta(days=i), v) for k, values in series.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, d date, price double")


def rows(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.k, r.step)):
        out.setdefault(r.k, []).append(r)
    return out


def test_without_season_and_bends_it_is_the_straight_line(spark):
    rng = np.random.default_rng(1)
    df = frame(spark, a=(50 + np.arange(40) * 0.5 + rng.normal(0, 1, 40)).tolist(), b=(80 - np.arange(20) * 2.0 + rng.normal(0, 1, 20)).tolist(), c=[1.0] * 4)
    want = rows(trend.price_forecast(df, ["k"], "d"))
    got = rows(forecast.seasonal_forecast(df, ["k"], "d", harmonics=0, breaks=0))
    assert set(got) == set(want) == {"a", "b"}
    for k in want:
        for g, w in zip(got[k], want[k], strict=True):
            assert (g.forecast, g.lower, g.upper) == pytest.approx((w.forecast, w.lower, w.upper), rel=1e-9)


def test_planted_season_and_bend_are_recovered(spark):
    n, period = 100, 12
    wave = lambda t: 5 * math.sin(2 * math.pi * t / period) + 2 * math.cos(4 * math.pi * t / period)
    level = lambda t: 100 + 0.1 * t + (0.6 * (t - 60) if t > 60 else 0.0)
    rng = np.random.default_rng(2)
    df = frame(spark, a=[level(t) + wave(t) + rng.normal(0, 0.3) for t in range(n)])
    got = rows(forecast.seasonal_forecast(df, ["k"], "d", period=period, smooth=1e-5))["a"]
    for r in got[:12]:
        t = n - 1 + r.step
        assert abs(r.season - wave(t)) < 0.6
        assert abs(r.trend - level(t)) < 2.0
        assert r.lower < level(t) + wave(t) < r.upper
    flat = rows(forecast.seasonal_forecast(df, ["k"], "d", harmonics=0, breaks=0))["a"]
    error = lambda some: sum(abs(r.forecast - level(n - 1 + r.step) - wave(n - 1 + r.step)) for r in some)
    assert error(got) < error(flat) / 4


def test_coefficients_equal_a_plain_fit():
    """Sums of products against least squares on the rows themselves, penalty as extra rows."""
    rng = np.random.default_rng(3)
    last, period, harmonics, breaks, n, smooth = 50, 7, 1, 3, 40, 0.2
    back = np.arange(n, 0, -1)
    x = forecast.ahead(1.0 - back, last, period, harmonics, breaks)
    y = rng.normal(size=n)
    beta, _ = forecast.solve(x.T @ x, x.T @ y, n, slice(2, 5), smooth)
    extra = np.zeros((3, x.shape[1]))
    extra[range(3), range(2, 5)] = math.sqrt(smooth * n)
    want = np.linalg.lstsq(np.vstack([x, extra]), np.concatenate([y, np.zeros(3)]), rcond=None)[0]
    assert beta == pytest.approx(want)


def test_limits_and_short_series(spark):
    df = frame(spark, down=[100.0 - 4 * i for i in range(20)], short=[1.0, 2.0, 3.0, 4.0, 5.0], few=[1.0] * 4)
    got = rows(forecast.seasonal_forecast(df, ["k"], "d"))
    assert set(got) == {"down", "short"}
    assert all(r.season == 0 for k in got for r in got[k])  # under two seasons long
    mean = np.mean([100.0 - 4 * i for i in range(20)])
    steps = np.diff([r.trend for r in got["down"]])
    assert steps == pytest.approx([-0.1 * mean / 30] * 29)
    assert all(24 <= r.lower <= r.forecast <= r.upper <= 2 * mean for r in got["down"])
    assert forecast.seasonal_forecast(df.limit(0), ["k"], "d").count() == 0
