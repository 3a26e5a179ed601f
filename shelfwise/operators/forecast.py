"""Forecasts with a trend that may bend and a season, one least-squares fit per series.

Every observation becomes a row of basis functions: level, slope, a change of slope at fixed places in the look-back,
and sines and cosines of the season.  Their products are summed per series in the JVM, so what reaches Python is one
small system of equations per series, however many observations there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.trend import HORIZON, LOOKBACK, MIN_POINTS, history_tail

SMOOTH = 0.05  # weight of the penalty on changes of slope, a series' observations being one
DECLINE = 0.10  # the slope may not fall by more than this share of the mean in 30 steps


def basis(back: Column, last: int, period: int, harmonics: int, breaks: int) -> list[Column]:
    """Basis functions of an observation that is the ``back``-th from the end (1 is the newest)."""
    u = -back.cast("double") / F.lit(float(last))
    bends = [F.greatest(u + F.lit(j / (breaks + 1)), F.lit(0.0)) for j in range(1, breaks + 1)]
    angle = -back.cast("double") * F.lit(2 * math.pi / period)
    waves = [f(angle * F.lit(float(k))) for k in range(1, harmonics + 1) for f in (F.sin, F.cos)]
    return [F.lit(1.0), u, *bends, *waves]


def ahead(steps: np.ndarray, last: int, period: int, harmonics: int, breaks: int) -> np.ndarray:
    """The same functions ``steps`` after the newest observation (0 is that observation)."""
    at = steps - 1.0
    bends = [np.maximum(at / last + j / (breaks + 1), 0.0) for j in range(1, breaks + 1)]
    waves = [f(2 * np.pi / period * k * at) for k in range(1, harmonics + 1) for f in (np.sin, np.cos)]
    return np.stack([np.ones_like(at), at / last, *bends, *waves], axis=1)


def solve(gram: np.ndarray, right: np.ndarray, n: float, bends: slice, smooth: float) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients and the inverse they come from; only changes of slope are penalised."""
    penalty = np.zeros(len(right))
    penalty[bends] = smooth
    system = gram / n + np.diag(penalty)
    inverse = np.linalg.pinv(system, hermitian=True) / n
    return inverse @ right, inverse


def seasonal_forecast(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str = "price",
    horizon: int = HORIZON,
    last: int = LOOKBACK,
    period: int = 12,
    harmonics: int = 2,
    breaks: int = 4,
    smooth: float = SMOOTH,
) -> DataFrame:
    """(keys, step, forecast, lower, upper, trend, season) with a 95 % band, for series of 5 observations or more.

    ``period`` is the season's length in observations; a series needs twice that many for a season, else it gets none.
    Without ``harmonics`` and ``breaks`` this is the straight-line forecast.  Slopes fall by at most 10 % of the mean
    per 30 steps; values stay between the lowest observation and twice the mean.  Null values are left out; an empty
    table gives an empty result.
    """
    tail = history_tail(df.where(F.col(value).isNotNull()), keys, ts, last)
    x, y = basis(F.col("_back"), last, period, harmonics, breaks), F.col(value).cast("double")
    size = len(x)
    places = [(i, j) for i in range(size) for j in range(i, size)]
    rows = tail.select(*keys, y.alias("_y"), *[c.alias(f"_x{i}") for i, c in enumerate(x)])
    sums = [F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"g{i}_{j}") for i, j in places]
    sums += [F.sum(F.col(f"_x{i}") * F.col("_y")).alias(f"r{i}") for i in range(size)]
    fitted = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("_y").alias("sy"), F.sum(F.col("_y") * F.col("_y")).alias("syy"), F.min("_y").alias("low"), *sums
    )
    fitted = fitted.where(F.col("n") >= MIN_POINTS)
    trend, seasonal = 2 + breaks, 2 * harmonics
    schema = [f"`{k}` {fitted.schema[k].dataType.simpleString()}" for k in keys]
    names = list(keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps = np.arange(horizon + 1, dtype=float)
        future = ahead(steps, last, period, harmonics, breaks)
        for part in batches:
            out = []
            for row in part.to_dict("records"):
                gram = np.zeros((size, size))
                for i, j in places:
                    gram[i, j] = gram[j, i] = row[f"g{i}_{j}"]
                used = trend + (seasonal if row["n"] >= 2 * period else 0)
                gram, right, n = gram[:used, :used], np.array([row[f"r{i}"] for i in range(used)]), row["n"]
                beta, inverse = solve(gram, right, n, slice(2, trend), smooth)
                at = future[:, :used]
                mean = row["sy"] / n
                own = beta.copy()
                own[trend:] = 0.0
                line = at @ own
                slope = float(line[1] - line[0])
                slope = max(slope, -DECLINE * mean / 30.0)
                line = line[0] + slope * steps
                season = at @ beta - at @ own
                left = max(row["syy"] - 2 * beta @ right + beta @ gram @ beta, 0.0)
                # degrees of freedom that the fit takes, fewer than its functions where slopes are held back
                spent = float(np.trace(inverse @ gram))
                error = np.sqrt(left / max(n - spent, 1.0)) if n > spent else 0.0
                spread = 1.96 * error * np.sqrt(1.0 + np.einsum("ij,jk,ik->i", at, inverse, at))
                hold = lambda v: np.clip(v, row["low"], max(2.0 * mean, row["low"]))
                point = line + season
                out.append(
                    pd.DataFrame(
                        {k: [row[k]] * horizon for k in names}
                        | {"step": np.arange(1, horizon + 1, dtype=np.int32), "forecast": hold(point)[1:]}
                        | {"lower": hold(point - spread)[1:], "upper": hold(point + spread)[1:]}
                        | {"trend": line[1:], "season": season[1:]}
                    )
                )
            if out:
                yield pd.concat(out)

    fields = "step int, forecast double, lower double, upper double, trend double, season double"
    return fitted.mapInPandas(run, ", ".join([*schema, fields]))
