"""Forecasts of daily event values by type."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medley.operators import seasonal, series
from medley.plans.base import Tables, money, number, query


def history(t: Tables) -> DataFrame:
    """Daily sums by event type, exact before they become doubles."""
    rows = series.daily(t.events, "event_type", "ts", money("value"))
    return rows.withColumn("y", number(F.col("y")))


def order_history(t: Tables) -> DataFrame:
    """Daily order totals by priority: six and a half years."""
    rows = series.daily(t.orders, "o_orderpriority", "o_orderdate", money("o_totalprice"))
    return rows.withColumn("y", number(F.col("y")))


DAILY = """
WITH h AS (SELECT event_type, CAST(ts AS DATE) AS ds, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS y FROM events GROUP BY ALL)
"""

# Trend times weekday, by key k: the same definition in SQL.
MODEL = """
, line AS (SELECT k, regr_slope(y, ds - DATE '1970-01-01') AS slope, avg(y) AS ym, avg(ds - DATE '1970-01-01') AS tm, max(ds) AS last FROM cut GROUP BY k),
d AS (SELECT k, ds, y, ym + slope * ((ds - DATE '1970-01-01') - tm) AS trend, dayofweek(ds) AS dow FROM cut JOIN line USING (k) WHERE slope IS NOT NULL),
f AS (SELECT k, dow, coalesce(avg(CASE WHEN trend <> 0 THEN y / trend END), 1.0) AS factor FROM d GROUP BY k, dow),
s AS (SELECT k, coalesce(stddev_samp(y - trend * factor), 0.0) AS sigma FROM d JOIN f USING (k, dow) GROUP BY k),
p AS (SELECT x.k, x.ds, (ym + slope * ((x.ds - DATE '1970-01-01') - tm)) * coalesce(factor, 1.0) AS yhat, sigma,
  ym + slope * ((x.ds - DATE '1970-01-01') - tm) AS trend, coalesce(factor, 1.0) AS factor
 FROM (SELECT *, CAST(last + CAST(i AS INTEGER) AS DATE) AS ds FROM line, range(1, {horizon} + 1) r(i)) x JOIN s ON s.k = x.k
 LEFT JOIN f ON f.k = x.k AND f.dow = dayofweek(x.ds))
"""


@query(DAILY + ", cut AS (SELECT event_type AS k, ds, y FROM h WHERE ds <= DATE '2024-01-25')" + MODEL.format(horizon=5) + """
SELECT k AS event_type, CAST(ds AS VARCHAR) AS ds, round(yhat, 4) AS yhat, round(yhat - 1.2815515655446004 * sigma, 4) AS yhat_lower,
 round(yhat + 1.2815515655446004 * sigma, 4) AS yhat_upper FROM p
""")
def forecast_rows(t: Tables) -> DataFrame:
    """[M01, M02] Five days ahead of a cutoff."""
    rows = series.forecast(series.up_to(history(t), "ds", dt.date(2024, 1, 25)), ["event_type"], 5)
    return rows.select("event_type", F.col("ds").cast("string").alias("ds"), *[F.round(c, 4).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")])


ORIGINS = """
, cut AS (SELECT event_type || '/' || CAST(o AS VARCHAR) AS k, ds, y FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ds DESC) AS back FROM h),
 (VALUES (10), (13), (16)) v(o) WHERE back > o)
"""


@query(DAILY + ORIGINS + MODEL.format(horizon=5) + """
SELECT event_type, CAST(string_split(k, '/')[2] AS INTEGER) AS origin, count(*) AS n, round(avg(CASE WHEN y <> 0 THEN abs(y - yhat) / abs(y) END), 6) AS mape,
 round(sqrt(avg((y - yhat) * (y - yhat))), 4) AS rmse FROM p JOIN h ON h.event_type = string_split(k, '/')[1] AND h.ds = p.ds GROUP BY ALL
""")
def backtest_scores(t: Tables) -> DataFrame:
    """[M03, M04, M05] Rolling origins joined with actuals, scored."""
    rows = series.scores(series.backtest(history(t), ["event_type"], [10, 13, 16]), ["event_type", "origin"])
    return rows.select("event_type", "origin", "n", F.round("mape", 6).alias("mape"), F.round("rmse", 4).alias("rmse"))


ORDER_DAILY = """
WITH RECURSIVE h AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS ds, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS y FROM orders GROUP BY ALL)
"""

BACK = "(SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY ds DESC) AS back FROM h)"


def _rounded(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"mape": F.round("mape", 6), "rmse": F.round("rmse", 2)})


@query(ORDER_DAILY + f", cut AS (SELECT o_orderpriority || '/' || o AS k, ds, y FROM {BACK}, range(10, 181, 5) v(o) WHERE back > o)" + MODEL.format(horizon=5) + """
SELECT o_orderpriority, count(*) AS n, round(avg(CASE WHEN y <> 0 THEN abs(y - yhat) / abs(y) END), 6) AS mape,
 round(sqrt(avg((y - yhat) * (y - yhat))), 2) AS rmse FROM p JOIN h ON h.o_orderpriority = string_split(k, '/')[1] AND h.ds = p.ds GROUP BY 1
""")
def backtest_orders(t: Tables) -> DataFrame:
    """[M03] Thirty-five origins over years of orders."""
    return _rounded(series.scores(series.backtest(order_history(t), ["o_orderpriority"]), ["o_orderpriority"]))


@query(ORDER_DAILY + f"""
, every AS (SELECT o_orderpriority || '/' || o || '/' || w AS k, w, ds, y FROM {BACK}, (VALUES (10), (20), (30), (40)) v(o), (VALUES (60), (365), (3650)) u(w) WHERE back > o),
cut AS (SELECT k, ds, y FROM (SELECT *, max(ds) OVER (PARTITION BY k) AS last_ds FROM every) WHERE last_ds - ds < w)""" + MODEL.format(horizon=5) + """
SELECT o_orderpriority, CAST(string_split(k, '/')[3] AS INTEGER) AS "window", CAST(strength AS DOUBLE) AS strength, count(*) AS n,
 round(avg(CASE WHEN y <> 0 THEN abs(y - yh) / abs(y) END), 6) AS mape, round(sqrt(avg((y - yh) * (y - yh))), 2) AS rmse
FROM (SELECT h.o_orderpriority, k, strength, y, trend * (1 + strength * (factor - 1)) AS yh
 FROM p JOIN h ON h.o_orderpriority = string_split(k, '/')[1] AND h.ds = p.ds, (VALUES (0.0), (0.5), (1.0)) s(strength)) GROUP BY 1, 2, 3
""")
def parameter_grid(t: Tables) -> DataFrame:
    """[M06] Settings scored by RMSE."""
    params = [(w, s) for w in (60, 365, 3650) for s in (0.0, 0.5, 1.0)]
    return _rounded(series.grid(order_history(t), ["o_orderpriority"], params, [10, 20, 30, 40]))


@query(ORDER_DAILY + """
, r AS (SELECT o_orderpriority AS k, y, row_number() OVER (PARTITION BY o_orderpriority ORDER BY ds) AS i, count(*) OVER (PARTITION BY o_orderpriority) AS c FROM h),
tr AS (SELECT k, i, y, CAST(c - ceil(c * 0.05) AS BIGINT) AS n FROM r WHERE i <= c - ceil(c * 0.05)),
te AS (SELECT k, i - CAST(c - ceil(c * 0.05) AS BIGINT) AS h, y FROM r WHERE i > c - ceil(c * 0.05)),
m AS (SELECT k, n, avg(y) AS mean FROM tr GROUP BY k, n),
f AS (SELECT k, (i - 1) % 12 AS seat, CASE WHEN any_value(m.n) >= 24 THEN avg(y) / any_value(mean) ELSE 1.0 END AS f FROM tr JOIN m USING (k) GROUP BY ALL),
a AS (SELECT tr.k, i, n, y / f AS a FROM tr JOIN f ON tr.k = f.k AND (i - 1) % 12 = seat),
ses(k, alpha, i, level, sse) AS (
 SELECT k, x * 0.05::DOUBLE, 1::BIGINT, a, 0.0::DOUBLE FROM a, range(1, 20) g(x) WHERE i = 1
 UNION ALL SELECT s.k, alpha, s.i + 1, level + alpha * (a - level), sse + (a - level) * (a - level) FROM ses s JOIN a ON a.k = s.k AND a.i = s.i + 1),
best AS (SELECT ses.k, alpha, level, n FROM ses JOIN m ON ses.k = m.k AND ses.i = m.n QUALIFY row_number() OVER (PARTITION BY ses.k ORDER BY sse, alpha) = 1),
slope AS (SELECT k, regr_slope(a, i) / 2 AS drift FROM a GROUP BY k),
ahead AS (SELECT te.k, y, (level + drift * (h - 1 + (1 - pow(1 - alpha, n)) / alpha)) * f AS yhat
 FROM te JOIN best USING (k) JOIN slope USING (k) JOIN f ON f.k = te.k AND (n + h - 1) % 12 = seat)
SELECT k AS o_orderpriority, count(*) AS n, round(avg(CASE WHEN y <> 0 THEN abs(y - yhat) / abs(y) END), 6) AS mape,
 round(sqrt(avg((y - yhat) * (y - yhat))), 2) AS rmse FROM ahead GROUP BY 1
""")
def theta_scores(t: Tables) -> DataFrame:
    """[M05] Theta on the ordered split, scored by MAPE over all test days of each series."""
    keys = ["o_orderpriority"]
    train, test = series.split(order_history(t), keys, 0.05)
    order = F.row_number().over(series.Window.partitionBy(*keys).orderBy("ds"))
    lengths = test.groupBy(*keys).agg(F.count(F.lit(1)).alias("horizon"))
    predicted = series.theta(train, keys, lengths)
    return _rounded(series.scores(predicted.join(test.withColumn("h", order), [*keys, "h"]), keys))


@query()
def seasonal_forecast(t: Tables) -> DataFrame:
    """[M01, M02] Thirty days of orders ahead of a cutoff, by trend with changepoints, week and year. Compared with a plain fit in the tests."""
    cut = series.up_to(order_history(t), "ds", dt.date(1998, 6, 1))
    rows = seasonal.predict(seasonal.fit(cut, ["o_orderpriority"]), ["o_orderpriority"], 30)
    return rows.select("o_orderpriority", F.col("ds").cast("string").alias("ds"), *[F.round(c, 2).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")])


@query()
def prior_grid(t: Tables) -> DataFrame:
    """[M06] Sixteen settings of the priors scored over four origins, thirty days each. Compared with plain fits in the tests."""
    priors = [seasonal.Prior(c, s) for c in (0.001, 0.01, 0.1, 0.5) for s in (0.01, 0.1, 1.0, 10.0)]
    return _rounded(seasonal.prior_grid(order_history(t), ["o_orderpriority"], priors, [30, 90, 180, 365]))
