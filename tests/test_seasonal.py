import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from medley.operators import seasonal, series
from medley.operators.seasonal import Prior, Shape

START = dt.date(2020, 1, 1)
SMALL = Shape(changepoints=5, weekly=2, yearly=2)


def value(i, kind):
    bend = 0.05 * i if i < 500 else 25 - 0.04 * (i - 500)
    week, year = 3 * math.sin(2 * math.pi * i / 7), 8 * math.cos(2 * math.pi * i / 365.25)
    noise = ((i * 7919) % 101 - 50) / 100
    return 50 + (bend if kind != "flat" else 0) + week + year + noise


@pytest.fixture(scope="module")
def history(spark):
    rows = [(k, START + dt.timedelta(days=i), value(i, k)) for k in ("bent", "flat") for i in range(900)]
    return spark.createDataFrame([*rows, ("bent", START + dt.timedelta(days=950), None), ("one", START, 1.0)], "k string, ds date, y double").cache()


def plain(days, y, prior, shape, first, last, scale):
    """Ridge regression on the rows themselves, by least squares with the penalties as further rows."""
    t = (days - first) / (last - first)
    x = [np.ones(len(t)), t] + [np.clip(t - shape.share * k / (shape.changepoints + 1), 0, None) for k in range(1, shape.changepoints + 1)]
    for period, order in ((7, shape.weekly), (365.25, shape.yearly)):
        for k in range(1, order + 1):
            x += [np.sin(2 * np.pi * k * days / period), np.cos(2 * np.pi * k * days / period)]
    x, y = np.array(x).T, y / scale
    stacked = lambda p: np.linalg.lstsq(np.vstack([x, np.diag(np.sqrt(p))]), np.concatenate([y, np.zeros(x.shape[1])]), rcond=None)[0]
    variance = np.mean((y - x @ stacked(np.full(x.shape[1], 1e-6))) ** 2)
    width = np.array([5.0] * 2 + [prior.changepoint] * shape.changepoints + [prior.season] * 2 * (shape.weekly + shape.yearly))
    beta = stacked(variance / width**2 + 1e-9)
    return beta, math.sqrt(np.mean((y - x @ beta) ** 2))


def test_all_origins_and_priors_equal_fits_on_the_rows(history):
    priors, origins = [Prior(0.01, 0.5), Prior(0.5, 10.0)], [0, 37, 400]
    models = seasonal.fit(history, ["k"], priors, origins, SMALL).toPandas()
    assert len(models) == 2 * 2 * 3
    epoch = (START - dt.date(1970, 1, 1)).days
    for row in models.itertuples():
        y = np.array([value(i, row.k) for i in range(900)])
        days = epoch + np.arange(900.0)
        cut = 900 - row.origin
        beta, sigma = plain(days[:cut], y[:cut], Prior(row.changepoint, row.season), SMALL, days[0], days[-1], np.abs(y).max())
        assert row.n == cut and row.end_day == epoch + cut - 1
        x = SMALL.features(days, days[0], days[-1])
        assert np.allclose(x[:cut] @ row.beta, x[:cut] @ beta, atol=1e-6) and math.isclose(row.sigma, sigma, rel_tol=1e-4)


def test_better_than_a_line_with_weekdays(history):
    known = history.filter("k <> 'one' AND y IS NOT NULL")
    cut = series.up_to(known, "ds", START + dt.timedelta(days=839))
    own = seasonal.predict(seasonal.fit(cut, ["k"]), ["k"], 60)
    line = series.forecast(cut, ["k"], 60)
    errors = [dict(series.scores(series.with_actuals(p, known, ["k"]), ["k"]).select("k", "rmse").collect()) for p in (own, line)]
    assert all(errors[0][k] < 0.5 * errors[1][k] for k in ("bent", "flat")) and errors[0]["flat"] < 1
    inside = series.with_actuals(own, known, ["k"]).filter("k = 'flat' AND y BETWEEN yhat_lower AND yhat_upper").count()
    assert 30 <= inside <= 60 and own.count() == 120


def test_grid_reads_the_history_once(history, spark):
    priors = [Prior(c, s) for c in (0.01, 0.5) for s in (0.1, 10.0)]
    grid = seasonal.prior_grid(history, ["k"], priors, [30, 60], 10, SMALL).toPandas()
    assert len(grid) == 8 and (grid.n == 20).all()
    alone = seasonal.prior_grid(history, ["k"], priors[3:], [30, 60], 10, SMALL).toPandas()
    merged = grid.merge(alone, on=["k", "changepoint", "season"])
    assert len(merged) == 2 and np.allclose(merged.rmse_x, merged.rmse_y)
    plan = seasonal.fit(history, ["k"], priors, [30, 60], SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("FlatMapGroupsInPandas") == 1


def test_empty(history):
    assert seasonal.predict(seasonal.fit(history.limit(0), ["k"]), ["k"], 5).count() == 0
    assert seasonal.fit(history.filter("k = 'one'"), ["k"]).count() == 0
    assert seasonal.fit(history.filter(F.lit(True)), ["k"], origins=[890, 899]).count() == 2
