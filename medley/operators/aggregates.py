"""Aggregations. All of them combine on the map side, so hot keys shrink before they travel."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medley.functions.numbers import percent
from medley.operators import quantiles


def averages(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """[A06] Average of every numeric column by key."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in by]
    return df.groupBy(*by).agg(*[F.avg(c).alias(f"avg_{c}") for c in numeric])


def agg_set(df: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    """[A08] Sum, mean and sample standard deviation in one pass."""
    return df.groupBy(*by).agg(
        F.sum(column).alias("total"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std")
    )


def describe(df: DataFrame, column: str) -> DataFrame:
    """[A09] Count, mean, standard deviation, minimum, exact quartiles and maximum, in one row."""
    q1, q2, q3 = quantiles.quantiles(df, column, [0.25, 0.5, 0.75])
    c = F.col(column)
    return df.agg(
        F.count(c).alias("n"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"),
        F.min(c).alias("low"),
        F.lit(q1).alias("q1"),
        F.lit(q2).alias("q2"),
        F.lit(q3).alias("q3"),
        F.max(c).alias("high"),
    )


def describe_text(df: DataFrame) -> DataFrame:
    """[A09] Count, smallest and largest text of every text column, one row per column."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    one = df.agg(
        *[
            F.struct(F.count(n).alias("n"), F.min(n).alias("low"), F.max(n).alias("high")).alias(n)
            for n in names
        ]
    )
    return _by_column(one, names)


def profile(df: DataFrame) -> DataFrame:
    """[A10] Type and non-null count of every column, in one pass over the data."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    one = df.agg(
        *[F.struct(F.lit(kinds[n]).alias("kind"), F.count(F.col(f"`{n}`")).alias("n")).alias(n) for n in df.columns]
    )
    return _by_column(one, df.columns)


def _by_column(one: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row of structs as one row per column."""
    entries = F.array(*[F.struct(F.lit(n).alias("column"), F.col(f"`{n}`").alias("s")) for n in names])
    return one.select(F.explode(entries).alias("e")).select("e.column", "e.s.*")


def by_quarter(df: DataFrame, at: str, column: str) -> DataFrame:
    """[A11] Sum by calendar quarter (1 to 4)."""
    return df.groupBy(F.quarter(at).alias("quarter")).agg(F.sum(column).alias("total"))


def daily_metric(
    df: DataFrame,
    at: str,
    metric: str,
    today: dt.date,
    watermark: dt.date | None = None,
    key: str | None = None,
) -> DataFrame:
    """[A13, A14, C05] Daily sum of a configured column, optionally by one more key.

    Days after `today` and days up to the watermark are left out; no watermark takes everything.
    """
    day = F.to_date(F.col(at))
    rows = df.filter(day <= F.lit(today))
    if watermark is not None:
        rows = rows.filter(day > F.lit(watermark))
    keys = [day.alias("day")] + ([F.col(key)] if key else [])
    return rows.groupBy(*keys).agg(F.sum(metric).alias("metric"))


def watermark(df: DataFrame, column: str):
    """[A12, C05] Largest value of a column, None for an empty frame."""
    return df.agg(F.max(column)).first()[0]


def ratio(df: DataFrame, part: str, whole: str, out: str = "percent") -> DataFrame:
    """[A15] Ratio of two totals in percent, null if the divisor is 0."""
    return df.agg(F.sum(part).alias("part"), F.sum(whole).alias("whole")).withColumn(
        out, percent(F.col("part"), F.col("whole"))
    )


def value_sets(df: DataFrame, by: Sequence[str], column: str, out: str = "items") -> DataFrame:
    """[A16] Sorted distinct values by key, nulls left out, for keys known to have few values: a list is one cell.

    Duplicates are removed before any list is built; `group_members` gives the same as rows, for keys of any size.
    """
    values = df.select(*by, column).dropna(subset=[column]).distinct()
    return values.groupBy(*by).agg(F.array_sort(F.collect_list(column)).alias(out))


def shop_batches(requests: DataFrame, shop: str) -> DataFrame:
    """[A17] Requests of one shop side by side in one partition, ordered.

    A shop has as many requests as there are APIs, so no partition can grow with the data.
    """
    return requests.repartition(shop).sortWithinPartitions(shop, *[c for c in requests.columns if c != shop])


def group_members(df: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """[A22] Group listing as rows (group, key) in order; a list per group would not fit hot groups."""
    return df.select(*by, key).distinct().orderBy(*by, key)


def get_group(df: DataFrame, by: str, value) -> DataFrame:
    """[A22] The rows of one chosen group."""
    return df.filter(F.col(by) == value)


def line_counts(lines: DataFrame, path: str, pattern: str = r"(\d{4}-\d{2}-\d{2})") -> DataFrame:
    """[A20] Lines per report date, the date read out of the file path. Ours: every text line counts."""
    day = F.try_to_date(F.regexp_extract(F.col(path), pattern, 1), "yyyy-MM-dd")
    return lines.groupBy(day.alias("report_date")).agg(F.count(F.lit(1)).alias("raw_line_count"))
