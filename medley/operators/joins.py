"""Joins that Spark has no single operator for."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medley.operators.skew import lookup, one_per_key, running


def enrich(df: DataFrame, master: DataFrame, keys: Sequence[str], flag: str = "unmatched") -> DataFrame:
    """[J13] Left lookup in master data with a flag on rows that found nothing; a master key that occurs twice is an error."""
    marked = one_per_key(master, keys, "master data").withColumn("_found", F.lit(True))
    return lookup(df, marked, keys).withColumn(flag, F.col("_found").isNull()).drop("_found")


def interval_join(
    left: DataFrame,
    ranges: DataFrame,
    on: tuple[str, str],
    at: str,
    start: str,
    end: str,
    how: str = "left",
) -> DataFrame:
    """[J04, K04] Rows joined to the ranges of their key that contain their day, both ends inclusive.

    A row in two ranges comes out twice, a row in none stays (left). The distinct (key, day) pairs of the rows, no more
    than keys times calendar days, meet the ranges by key and month; the rows then take their pair's ranges by an equi-join
    on key and day. No list of ranges is gathered, and Spark chooses both joins' methods from the real sizes.
    """
    day = F.to_date(F.col(at))
    key, other = on
    dated = left.withColumn("_day", day)
    pairs = dated.select(F.col(key).alias("_key"), "_day").dropna().distinct().withColumn("_in", F.trunc("_day", "month"))
    span = pairs.agg(F.min("_day").alias("_lo"), F.max("_day").alias("_hi"))  # one row
    first, last = F.greatest(F.to_date(F.col(start)), F.col("_lo")), F.least(F.to_date(F.col(end)), F.col("_hi"))
    months = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))
    cut = ranges.join(F.broadcast(span)).filter(first <= last).select(F.struct(*ranges.columns).alias("_range"), F.explode(months).alias("_month"))
    bounds = [F.to_date(F.col(f"_range.{c}")) for c in (start, end)]
    hit = (F.col("_key") == F.col(f"_range.{other}")) & (F.col("_in") == F.col("_month")) & F.col("_day").between(*bounds)
    found = pairs.join(cut, hit).select("_key", F.col("_day").alias("_on"), "_range")
    joined = dated.join(found, (F.col(key) == F.col("_key")) & (F.col("_day") == F.col("_on")), how)
    return joined.select(*[dated[c] for c in left.columns], "_range.*")


def overlapping(ranges: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """[J04] Ranges that start inside another range of their key: rows there would be doubled.

    Compares each start day with the latest end before it; a sorted scan per key, no pairs.
    """
    days = ranges.withColumn("_from", F.to_date(start)).withColumn("_to", F.to_date(end))
    ends = days.groupBy(key, "_from").agg(F.max("_to").alias("_end"), F.count(F.lit(1)).alias("_n"))
    seen = running(ends, [key], ["_from"], {"_latest": ("max", "_end")})
    starts = seen.select(key, "_from", "_latest", "_n", "_end")
    earlier = Window.partitionBy(key).orderBy("_from")
    clash = starts.withColumn("_before", F.lag("_latest").over(earlier)).filter(
        (F.col("_from") <= F.col("_before")) | (F.col("_n") > 1)
    )
    return lookup(days, clash.select(key, "_from"), [key, "_from"], "left_semi").select(*ranges.columns)


def asof(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    at: str,
    values: Mapping[str, str],
    tie: str | None = None,
    parts: int | None = None,
) -> DataFrame:
    """[J05] For each left row the last right row of its group at or before its time.

    `values` maps a right column to its output name; equal times match; `tie` decides among right rows
    of one time (the largest wins; without it a hash of the values decides). Both sides are stacked and
    scanned once in time order, part by part, whatever one group holds. A null value on the right is still
    a match.
    """
    packed = F.struct(*[F.col(v).alias(o) for v, o in values.items()]).alias("_v")
    among = (F.col(tie) if tie else F.xxhash64(*values)).alias("_among")
    points = right.filter(F.col(at).isNotNull()).select(*by, at, packed, F.lit(0).alias("_side"), among)
    asked = left.select(*by, at, F.struct(*left.columns).alias("_row"), F.lit(1).alias("_side"))
    stacked = points.unionByName(asked, allowMissingColumns=True)
    scanned = running(stacked, by, [at, "_side", "_among"], {"_hit": ("last", "_v")}, parts)
    return scanned.filter("_side = 1").select("_row.*", "_hit.*")


def anti(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """[J06, J10] Left rows whose key is not on the right.

    Right keys are reduced to one row each before they travel. Left rows with a null key have no
    partner by definition, so they bypass the join and do not pile up in one partition.
    """
    known = right.select(*keys).dropna().distinct()
    full = F.lit(True)
    for k in keys:
        full = full & F.col(k).isNotNull()
    return lookup(left.filter(full), known, keys, "left_anti").unionByName(left.filter(~full))


def semi(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """[J08, L07] Left rows whose key is on the right, each once."""
    known = right.select(*keys).dropna().distinct()
    return lookup(left.dropna(subset=list(keys)), known, keys, "left_semi")


def differences(a: DataFrame, b: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """[J07] Values only in `a`, and values only in `b`; distinct, null ignored."""
    left, right = a.select(column).dropna().distinct(), b.select(column).dropna().distinct()
    return left.join(right, column, "left_anti"), right.join(left, column, "left_anti")


def requests(
    shops: DataFrame,
    shop: str,
    apis: Sequence[tuple[str, str]],
    fill: Mapping[str, Any],
    inactive: DataFrame | None = None,
    only: str | None = None,
) -> DataFrame:
    """[J09, J10, T06] One request per shop and API, placeholders in the URL filled in, distinct.

    The API list is configuration: each shop row is exploded over it. `inactive` shops are removed first;
    `only` limits the run to one shop, without it all shops are covered.
    """
    rows = shops if only is None else shops.filter(F.lower(F.col(shop)) == only.lower())
    if inactive is not None:
        rows = anti(rows, inactive, [shop])
    entries = F.array(*[F.struct(F.lit(k).alias("api"), F.lit(u).alias("url")) for k, u in apis])
    out = rows.select(F.col(shop).alias("shop_domain"), F.explode(entries).alias("a"))
    url = F.replace(F.col("a.url"), F.lit("{shop_domain}"), F.col("shop_domain"))
    for name, value in fill.items():
        url = F.replace(url, F.lit("{" + name + "}"), F.lit(str(value)))
    return out.select("shop_domain", F.col("a.api").alias("api"), url.alias("url")).distinct()


def config_lookup(config: DataFrame, values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """[J12] Configuration rows with their value list; both sides are small by nature, size decides."""
    return config.join(values, list(keys), "left")


def compare_totals(a: DataFrame, b: DataFrame) -> DataFrame:
    """[J11, C03] Row counts of two frames side by side in one row, without a cross join."""
    sides = a.select(F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    totals = sides.agg(
        F.coalesce(F.sum("_a"), F.lit(0)).alias("rows_a"), F.coalesce(F.sum("_b"), F.lit(0)).alias("rows_b")
    )
    return totals.withColumn("equal", F.col("rows_a") == F.col("rows_b"))
