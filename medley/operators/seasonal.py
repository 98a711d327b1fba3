"""Seasonal forecasts for many series: a trend with changepoints, and Fourier terms for week and year.

A model is linear in its features, so all that its fit needs of a history is the sum of the features' products. These
matrices are summed once per series and stretch between two origins; every origin and every setting of the priors is then
solved from them, and the history is neither copied nor read again. A series has a row a day, so it is no longer than the
calendar. Values are ours and do not equal any library's.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medley.operators.series import Z80, scores, with_actuals

YEAR = 365.25
FREE = 5.0


@dataclass(frozen=True)
class Shape:
    """Features of a model: changepoints evenly over the first `share` of the history, and Fourier orders."""

    changepoints: int = 25
    share: float = 0.8
    weekly: int = 3
    yearly: int = 10

    def features(self, day: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """A row of features for each day (since 1970) of a history between two days."""
        t = (day - first) / np.maximum(last - first, 1)
        columns = [np.ones(len(t)), t]
        columns += [np.maximum(t - self.share * k / (self.changepoints + 1), 0) for k in range(1, self.changepoints + 1)]
        for period, order in ((7.0, self.weekly), (YEAR, self.yearly)):
            for k in range(1, order + 1):
                angle = 2 * np.pi * k * day / period
                columns += [np.sin(angle), np.cos(angle)]
        return np.stack(columns, axis=1)

    def widths(self, prior: Prior) -> np.ndarray:
        """Standard deviation that the prior gives each coefficient."""
        return np.array([FREE] * 2 + [prior.changepoint] * self.changepoints + [prior.season] * 2 * (self.weekly + self.yearly))


@dataclass(frozen=True)
class Prior:
    """How far the trend may bend at a changepoint, and how far a season may swing, on values scaled to at most 1."""

    changepoint: float = 0.05
    season: float = 10.0


def solve(products: np.ndarray, target: np.ndarray, square: float, n: float, widths: np.ndarray) -> tuple[np.ndarray, float]:
    """Coefficients and spread of the residuals, from the sums alone.

    Ridge regression whose penalties are the residual variance over the prior's; the variance is that of a fit with hardly
    any penalty.
    """

    def fitted(penalty: np.ndarray) -> tuple[np.ndarray, float]:
        beta = np.linalg.solve(products + np.diag(penalty), target)
        return beta, max(0.0, square - 2 * beta @ target + beta @ products @ beta) / n

    _, variance = fitted(np.full(len(target), 1e-6))
    beta, residual = fitted(np.maximum(variance, 1e-12) / widths**2 + 1e-9)
    return beta, float(np.sqrt(residual))


MODEL = "origin int, changepoint double, season double, n long, first_day int, last_day int, end_day int, scale double, beta array<double>, sigma double"


def fit(
    history: DataFrame, keys: Sequence[str], priors: Sequence[Prior] = (Prior(),), origins: Sequence[int] = (0,), shape: Shape = Shape()
) -> DataFrame:
    """[M01, M06] A model per key, origin and prior: `keys` and MODEL.

    An origin leaves out so many rows before the end of a series; one that leaves fewer than two days gives no model. The
    history has a row per key and day (`ds`, `y`); rows without a value are left out, null keys are a series.
    """
    asked = sorted(set(origins))
    by = T.StructType([history.schema[k] for k in keys])
    out = T.StructType([*by.fields, *T.StructType.fromDDL(MODEL).fields])
    back = Window.partitionBy(*keys).orderBy(F.desc("ds"))
    day = F.datediff("ds", F.lit("1970-01-01").cast("date")).alias("day")
    rows = history.filter("y IS NOT NULL AND ds IS NOT NULL").select(*keys, day, F.col("y").cast("double").alias("y"), F.row_number().over(back).alias("back"))

    def models(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("day")
        days, y = frame.day.to_numpy(np.float64), frame.y.to_numpy()
        first, last, scale = days[0], days[-1], max(np.abs(y).max(), 1e-12)
        x, y = shape.features(days, first, last), y / scale
        # rows of stretch s are seen by the origins before s
        stretch = np.searchsorted(asked, frame.back.to_numpy(), "left")
        found: list[dict] = []
        products, target, square, n, end = np.zeros((x.shape[1],) * 2), np.zeros(x.shape[1]), 0.0, 0, first
        for i in range(len(asked) - 1, -1, -1):
            own = stretch == i + 1
            products, target = products + x[own].T @ x[own], target + x[own].T @ y[own]
            square, n = square + y[own] @ y[own], n + int(own.sum())
            end = days[own].max() if own.any() else end
            if n < 2:
                continue
            for prior in priors:
                beta, sigma = solve(products, target, square, n, shape.widths(prior))
                found.append({"origin": asked[i], "changepoint": prior.changepoint, "season": prior.season, "n": n, "first_day": int(first),
                              "last_day": int(last), "end_day": int(end), "scale": scale, "beta": beta, "sigma": sigma})
        return pd.DataFrame(found, columns=out.names[len(keys) :]).assign(**{k: frame[k].iloc[0] for k in keys})[out.names]

    return rows.groupBy(*keys).applyInPandas(models, out)


def predict(models: DataFrame, keys: Sequence[str], horizon: int, z: float = Z80, shape: Shape = Shape()) -> DataFrame:
    """[M01] The days after each model's last: `ds`, `yhat`, `yhat_lower`, `yhat_upper` beside keys, origin and prior."""
    ahead = models.withColumn("day", F.explode(F.sequence(F.col("end_day") + 1, F.col("end_day") + horizon)))
    kept = [*keys, "origin", "changepoint", "season"]
    schema = T.StructType([*(ahead.schema[c] for c in [*kept, "day"]), *T.StructType.fromDDL("yhat double, sigma double").fields])

    def computed(frames):  # noqa: ANN001, ANN202
        for frame in frames:
            x = shape.features(*(frame[c].to_numpy(np.float64) for c in ("day", "first_day", "last_day")))
            beta = np.stack(frame.beta.to_numpy()) if len(frame) else np.zeros((0, x.shape[1]))
            frame = frame.assign(yhat=(x * beta).sum(axis=1) * frame.scale, sigma=frame.sigma * frame.scale)
            yield frame[schema.names]

    rows = ahead.mapInPandas(computed, schema)
    bounds = [(F.col("yhat") + sign * z * F.col("sigma")).alias(n) for n, sign in (("yhat_lower", -1), ("yhat_upper", 1))]
    return rows.select(*kept, F.date_from_unix_date("day").alias("ds"), "yhat", *bounds)


def prior_grid(
    history: DataFrame, keys: Sequence[str], priors: Sequence[Prior], origins: Sequence[int], horizon: int = 30, shape: Shape = Shape()
) -> DataFrame:
    """[M06] MAPE and RMSE of every prior over rolling origins: all are solved from one set of sums per series."""
    predicted = predict(fit(history, keys, priors, origins, shape), keys, horizon, shape=shape)
    joined = with_actuals(predicted, history.select(*keys, "ds", "y"), keys)
    return scores(joined, [*keys, "changepoint", "season"])
