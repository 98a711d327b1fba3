import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from medley.operators import series

START = dt.date(2024, 1, 1)


def frame(spark, name, ys, gap=1):
    rows = [(name, START + dt.timedelta(days=i * gap), float(y)) for i, y in enumerate(ys)]
    return spark.createDataFrame(rows, "s string, ds date, y double")


def test_a_weekly_pattern_is_recovered(spark):
    ys = [(100 + 2 * i) * (1.5 if (START + dt.timedelta(days=i)).weekday() == 5 else 1.0) for i in range(70)]
    rows = series.forecast(frame(spark, "a", ys), ["s"], 7).orderBy("ds").collect()
    assert [r["ds"] for r in rows] == [START + dt.timedelta(days=70 + i) for i in range(7)]
    for i, r in enumerate(rows):
        want = (100 + 2 * (70 + i)) * (1.5 if r["ds"].weekday() == 5 else 1.0)
        assert abs(r["yhat"] - want) / want < 0.03
        assert r["yhat_lower"] <= r["yhat"] <= r["yhat_upper"]


def test_short_constant_and_gappy_series(spark):
    assert series.forecast(frame(spark, "a", [5]), ["s"], 3).count() == 0
    flat = series.forecast(frame(spark, "a", [4.0] * 20), ["s"], 3).collect()
    assert all(abs(r["yhat"] - 4) < 1e-9 and r["yhat_lower"] == pytest.approx(r["yhat_upper"]) for r in flat)
    assert series.forecast(frame(spark, "a", range(10), gap=3), ["s"], 4).count() == 4
    nulls = frame(spark, "a", [1, 2, 3]).withColumn("y", F.lit(None).cast("double"))
    assert series.forecast(nulls, ["s"], 2).count() == 0


def test_backtest_does_not_look_ahead(spark):
    ys = [10 + (i % 7) for i in range(60)]
    before = series.backtest(frame(spark, "a", ys), ["s"], [20], 5).select("ds", "yhat").orderBy("ds").collect()
    later = ys[:40] + [1e6] * 20
    after = series.backtest(frame(spark, "a", later), ["s"], [20], 5).select("ds", "yhat").orderBy("ds").collect()
    assert before == after and len(before) == 5
    assert before[0]["ds"] == START + dt.timedelta(days=40)
    assert series.backtest(frame(spark, "a", ys), ["s"], [60, 100], 5).count() == 0


def test_scores(spark):
    rows = spark.createDataFrame([("a", 0.0, 1.0), ("a", 2.0, 1.0), ("z", 0.0, 3.0)], "s string, y double, yhat double")
    got = {r["s"]: r for r in series.scores(rows, ["s"]).collect()}
    assert got["a"]["mape"] == 0.5 and got["a"]["rmse"] == 1.0
    assert got["z"]["mape"] is None and got["z"]["rmse"] == 3.0


def test_split_is_ordered(spark):
    train, test = series.split(frame(spark, "a", range(10)), ["s"], 0.25)
    assert train.count() == 7 and test.count() == 3
    assert train.agg(F.max("ds")).first()[0] < test.agg(F.min("ds")).first()[0]


def theta_by_hand(ys, horizon, season):
    ys, n = np.asarray(ys, float), len(ys)
    f = np.ones(season)
    if n >= 2 * season and ys.mean() != 0:
        seats = np.array([ys[s::season].mean() for s in range(season)]) / ys.mean()
        f = seats if np.all(seats != 0) else f
    a = ys / np.array([f[i % season] for i in range(n)])
    best = None
    for alpha in series.ALPHAS:
        level, sse = a[0], 0.0
        for v in a[1:]:
            sse += (v - level) ** 2
            level += alpha * (v - level)
        if best is None or sse < best[0]:
            best = (sse, alpha, level)
    _, alpha, level = best
    t = np.arange(n)
    slope = np.polyfit(t, a, 1)[0] if n > 1 else 0.0
    lag = (1 - (1 - alpha) ** n) / alpha
    return [(level + slope / 2 * (h - 1 + lag)) * f[(n + h - 1) % season] for h in range(1, horizon + 1)]


@pytest.mark.parametrize("n", [1, 2, 9, 40])
def test_theta_against_plain_python(spark, n):
    ys = [50 + 3 * math.sin(i) * 4 + i + (10 if i % 4 == 1 else 0) for i in range(n)]
    rows = series.theta(frame(spark, "a", ys), ["s"], 6, season=4).orderBy("h").collect()
    assert np.allclose([r["yhat"] for r in rows], theta_by_hand(ys, 6, 4))


def test_grid_orders_settings(spark):
    ys = [(100 + i) * (2.0 if i % 7 == 3 else 1.0) for i in range(120)]
    rows = series.grid(frame(spark, "a", ys), ["s"], [(90, 0.0), (90, 1.0)], [10, 20]).collect()
    assert [r["strength"] for r in rows] == [1.0, 0.0] and rows[0]["rmse"] < rows[1]["rmse"]
