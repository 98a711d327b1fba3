"""Forecasts for many series at once.

The model is trend times weekday: a straight line through the history, scaled by the average ratio of
actual to line on the same weekday. Every quantity in it is a grouped aggregate, so a series is fitted
by the same map-side aggregation as any sum; no series has to fit a worker. Values are ours and do not
equal any library's.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medley.operators.skew import lookup

# Width of an 80 % interval in standard deviations, and the day the time axis starts.
Z80 = 1.2815515655446004
EPOCH = dt.date(1970, 1, 1)


def daily(df: DataFrame, series: str, at: str, y: Column) -> DataFrame:
    """[M01] One row per series and day, with days as `ds` and the sum as `y`."""
    return df.groupBy(series, F.to_date(F.col(at)).alias("ds")).agg(F.sum(y).alias("y"))


def up_to(df: DataFrame, ds: str, cutoff: dt.date) -> DataFrame:
    """[M02] History up to and including a day."""
    return df.filter(F.col(ds) <= F.lit(cutoff))


def _axis(ds: Column) -> Column:
    return F.datediff(ds, F.lit(EPOCH)).cast("double")


def fit(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """[M01] One model per key: line, weekday factors (a map), spread of the residuals, last day.

    A key with fewer than two different days has no line and gives no row; weekdays without history
    count as factor 1. The line is fitted around each key's mean day to keep digits.
    """
    h = history.filter(F.col("y").isNotNull()).select(*keys, "ds", F.col("y").cast("double").alias("y"))
    line = (
        h.groupBy(*keys)
        .agg(
            F.regr_slope("y", _axis(F.col("ds"))).alias("slope"),
            F.avg("y").alias("y_mean"),
            F.avg(_axis(F.col("ds"))).alias("t_mean"),
            F.max("ds").alias("last_ds"),
            F.count(F.lit(1)).alias("n"),
        )
        .filter(F.col("slope").isNotNull())
    )
    trend = F.col("y_mean") + F.col("slope") * (_axis(F.col("ds")) - F.col("t_mean"))
    detrended = lookup(h, line, keys, "inner").withColumn("trend", trend)
    ratio = F.when(F.col("trend") != 0, F.col("y") / F.col("trend"))
    weekday = F.dayofweek("ds")
    factors = detrended.groupBy(*keys, weekday.alias("dow")).agg(
        F.coalesce(F.avg(ratio), F.lit(1.0)).alias("factor")
    )
    scored = lookup(detrended.withColumn("dow", weekday), factors, [*keys, "dow"])
    residual = F.col("y") - F.col("trend") * F.col("factor")
    spread = scored.groupBy(*keys).agg(F.coalesce(F.stddev_samp(residual), F.lit(0.0)).alias("sigma"))
    # Seven weekdays at most per key.
    packed = factors.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("dow", "factor"))).alias("factors"))
    return lookup(lookup(line, spread, keys), packed, keys)


def _predict(models: DataFrame, z: float, strength: Column) -> DataFrame:
    trend = F.col("y_mean") + F.col("slope") * (_axis(F.col("ds")) - F.col("t_mean"))
    factor = F.coalesce(F.try_element_at("factors", F.dayofweek("ds")), F.lit(1.0))
    rows = models.withColumn("yhat", trend * (1 + strength * (factor - 1)))
    return rows.withColumns(
        {"yhat_lower": F.col("yhat") - z * F.col("sigma"), "yhat_upper": F.col("yhat") + z * F.col("sigma")}
    )


def forecast(
    history: DataFrame, keys: Sequence[str], horizon: int, z: float = Z80, strength: Column | float = 1.0
) -> DataFrame:
    """[M01] The next `horizon` days of every series: ds, yhat, yhat_lower, yhat_upper.

    `strength` scales the weekday effect, from 0 (trend only) to 1. The history holds one row per series
    and day (see `daily`), so a series is never longer than the calendar.
    """
    days = F.sequence(F.date_add("last_ds", 1), F.date_add("last_ds", horizon))
    ahead = fit(history, keys).withColumn("ds", F.explode(days))
    weight = strength if isinstance(strength, Column) else F.lit(float(strength))
    return _predict(ahead, z, weight).select(*keys, "ds", "yhat", "yhat_lower", "yhat_upper")


def with_actuals(predicted: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """[M04, J03] Predictions next to the actual values of the same day."""
    return predicted.join(actual, [*keys, "ds"], "inner")


def origins(history: DataFrame, keys: Sequence[str], steps: Sequence[int]) -> DataFrame:
    """[M03] History copied once per origin: `step` rows before the end are cut off for each step.

    Positions from the end are counted by window over a series' days, which are as many as the calendar
    has, not as many as the source has rows. The steps are a literal list, exploded: no join.
    """
    back = Window.partitionBy(*keys).orderBy(F.desc("ds"))
    numbered = history.withColumn("_back", F.row_number().over(back))
    step = F.explode(F.array(*[F.lit(s) for s in steps]))
    return numbered.withColumn("origin", step).filter(F.col("_back") > F.col("origin")).drop("_back")


def backtest(
    history: DataFrame, keys: Sequence[str], steps: Sequence[int] = tuple(range(180, 5, -5)), horizon: int = 5,
    z: float = Z80,
) -> DataFrame:
    """[M03, M04] Rolling-origin forecasts joined with the actuals.

    Each origin is fitted only on rows at or before it. Origins beyond a series' length give no row.
    """
    predicted = forecast(origins(history, keys, steps), [*keys, "origin"], horizon, z)
    return with_actuals(predicted, history.select(*keys, "ds", "y"), keys)


def scores(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """[M05, M06] MAPE (null where all actuals are zero) and RMSE by key."""
    off = F.abs(F.col("y") - F.col("yhat"))
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.when(F.col("y") != 0, off / F.abs(F.col("y")))).alias("mape"),
        F.sqrt(F.avg(F.pow(F.col("y") - F.col("yhat"), F.lit(2)))).alias("rmse"),
    )


def split(history: DataFrame, keys: Sequence[str], test_share: float = 0.25) -> tuple[DataFrame, DataFrame]:
    """[M05] Ordered split of every series: the last share of its days is the test part, rounded up."""
    order = Window.partitionBy(*keys).orderBy("ds")
    whole = Window.partitionBy(*keys)
    ranked = history.withColumns(
        {"_i": F.row_number().over(order), "_n": F.count(F.lit(1)).over(whole)}
    ).withColumn("_train", F.col("_i") <= F.col("_n") - F.ceil(F.col("_n") * F.lit(test_share)))
    return ranked.filter("_train").drop("_i", "_n", "_train"), ranked.filter("not _train").drop("_i", "_n", "_train")


# Smoothing constants tried by the Theta model.
ALPHAS = tuple(round(0.05 * i, 2) for i in range(1, 20))


def theta(history: DataFrame, keys: Sequence[str], horizon: int | DataFrame, season: int = 12) -> DataFrame:
    """[M05] Theta forecasts by position: `h` from 1 to `horizon`, `yhat`.

    `horizon` is a number of steps, or a table (keys, horizon) of one for each series.

    Multiplicative season: mean of the values at a position in the season over the mean of all values (1
    where the series is shorter than two seasons or a mean is zero). On the seasonally adjusted values:
    simple exponential smoothing from the first value, the constant with the least squared one-step error
    (the smaller on a tie), plus half the slope of the line through them times
    `h - 1 + (1 - (1 - alpha)^n) / alpha`. A series is one array of its days; as long as the calendar.
    """
    points = F.array_sort(F.collect_list(F.struct("ds", F.col("y").cast("double").alias("y"))))
    values = history.filter("y is not null").groupBy(*keys).agg(F.transform(points, lambda r: r["y"]).alias("_ys"))
    zero = F.lit(0.0)

    def total(array: str | Column) -> Column:
        return F.aggregate(array, zero, lambda a, v: a + v)

    def seat_mean(seat: Column) -> Column:
        own = F.filter("_ys", lambda _, i: i % season == seat)
        return F.try_divide(total(own), F.size(own))

    n, mean = F.col("_n"), F.col("_mean")
    sized = values.withColumn("_n", F.size("_ys")).withColumn("_mean", total("_ys") / F.size("_ys"))
    seats = F.transform(F.sequence(F.lit(0), F.lit(season - 1)), lambda s: F.try_divide(seat_mean(s), mean))
    seasonal = sized.withColumn("_f", F.when(n >= 2 * season, seats))
    usable = F.col("_f").isNotNull() & ~F.exists("_f", lambda v: v.isNull() | (v == 0))
    seasonal = seasonal.withColumn("_f", F.when(usable, F.col("_f")).otherwise(F.array_repeat(F.lit(1.0), season)))
    adjusted = seasonal.withColumn("_a", F.transform("_ys", lambda v, i: v / F.get("_f", i % season))).drop("_ys")
    tried = adjusted.withColumn("alpha", F.explode(F.array(*[F.lit(x) for x in ALPHAS])))
    smoothed = F.aggregate(
        F.slice("_a", F.lit(2), n),
        F.struct(F.get("_a", 0).alias("level"), zero.alias("sse")),
        lambda s, v: F.struct(
            (s["level"] + F.col("alpha") * (v - s["level"])).alias("level"),
            (s["sse"] + F.pow(v - s["level"], F.lit(2))).alias("sse"),
        ),
    )
    scored = tried.withColumn("_s", smoothed)
    chosen = F.min_by(F.struct("alpha", "_s", "_a", "_f", "_n"), F.struct("_s.sse", "alpha"))
    best = scored.groupBy(*keys).agg(chosen.alias("_b")).select(*keys, "_b.*")
    t_mean, a_mean = (n - 1) / 2.0, total("_a") / n
    covariance = total(F.transform("_a", lambda v, i: (i - t_mean) * (v - a_mean)))
    variance = total(F.transform("_a", lambda _, i: F.pow(i - t_mean, F.lit(2))))
    drift = F.coalesce(F.try_divide(covariance, variance), zero) / 2
    lag = (1 - F.pow(1 - F.col("alpha"), n)) / F.col("alpha")
    best = lookup(best, horizon, keys, "inner") if isinstance(horizon, DataFrame) else best.withColumn("horizon", F.lit(horizon))
    ahead = best.withColumn("_drift", drift).filter("horizon > 0").withColumn("h", F.explode(F.expr("sequence(1, cast(horizon AS int))")))
    flat = F.col("_s.level") + F.col("_drift") * (F.col("h") - 1 + lag)
    seat = ((n + F.col("h") - 1) % season).cast("int")
    return ahead.select(*keys, "h", (flat * F.get("_f", seat)).alias("yhat"), "alpha")


def grid(
    history: DataFrame, keys: Sequence[str], params: Sequence[tuple[int, float]], steps: Sequence[int], horizon: int = 5
) -> DataFrame:
    """[M06] RMSE of every (window, strength) setting over a backtest, best setting first per key.

    A setting limits the history to the last `window` days before each origin and scales the weekday
    effect. Settings are a literal list, exploded over the copied history, so one job fits them all.
    """
    entries = F.array(*[F.struct(F.lit(w).alias("window"), F.lit(float(s)).alias("strength")) for w, s in params])
    cut = origins(history, keys, steps).withColumn("p", F.explode(entries)).select("*", "p.*").drop("p")
    group = [*keys, "origin", "window", "strength"]
    ends = cut.groupBy(*group).agg(F.max("ds").alias("_end"))
    near = lookup(cut, ends, group, "inner").filter(F.datediff("_end", "ds") < F.col("window"))
    predicted = forecast(near.drop("_end"), group, horizon, strength=F.col("strength"))
    joined = with_actuals(predicted, history.select(*keys, "ds", "y"), keys)
    return scores(joined, [*keys, "window", "strength"]).orderBy(*keys, "rmse", "window", "strength")
