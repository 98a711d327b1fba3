"""Layered business rules on sales. Each rule is a frame-to-frame step, run in a stated order."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medley.operators.skew import lookup, one_per_key

Step = Callable[[DataFrame], DataFrame]


def bad_weights(weights: DataFrame, key: Sequence[str], weight: str, tolerance: float = 1e-9) -> DataFrame:
    """[G01] Keys whose weights do not sum to 1."""
    sums = weights.groupBy(*key).agg(F.sum(weight).alias("total"))
    return sums.filter(F.abs(F.col("total") - 1) > tolerance)


def allocate(
    sales: DataFrame, weights: DataFrame, key: Sequence[str], area: str, weight: str, amount: str
) -> DataFrame:
    """[G01] Split a product's sales over areas by weight; a product without weights keeps one row.

    A key whose weights do not sum to 1 is an error when the result is read, as totals would change silently.
    """
    sums = weights.groupBy(*key).agg(F.sum(weight).alias("_sum"))
    wrong = F.raise_error(F.concat(F.lit("weights do not sum to 1: "), F.to_json(F.struct(*key))))
    shares = lookup(weights.select(*key, F.col(area).alias("_area"), F.col(weight).alias("_weight")), sums, key)
    # a filter, so that no plan can leave the check out
    whole = F.when(F.abs(F.col("_sum") - 1) <= 1e-9, F.lit(True)).otherwise(wrong.cast("boolean"))
    rows = lookup(sales, shares.filter(whole).drop("_sum"), key)
    return rows.withColumns({area: F.col("_area"), amount: F.col(amount) * F.coalesce("_weight", F.lit(1))}).drop("_area", "_weight")


def reallocate(sales: DataFrame, regions: DataFrame, key: Sequence[str], region: str, real: str) -> DataFrame:
    """[G02] Replace a distributor's region by the real one; unlisted rows keep theirs."""
    table = one_per_key(regions.select(*key, F.col(real).alias("_real")), key, "region table")
    return lookup(sales, table, key).withColumn(region, F.coalesce("_real", region)).drop("_real")


def convert(sales: DataFrame, factors: DataFrame, key: Sequence[str], factor: str, columns: Sequence[str]) -> DataFrame:
    """[G04] Multiply columns by a conversion factor, 1 where none is listed."""
    table = one_per_key(factors.select(*key, F.col(factor).alias("_factor")), key, "factor table")
    scale = F.coalesce(F.col("_factor"), F.lit(1))
    return lookup(sales, table, key).withColumns({c: F.col(c) * scale for c in columns}).drop("_factor")


def run_rules(df: DataFrame, rules: Sequence[Step]) -> DataFrame:
    """[G03, G05] Rules in sequence, each on the previous result; without rules the data passes through."""
    return reduce(lambda frame, rule: rule(frame), rules, df)


def region_subset(df: DataFrame, config: DataFrame, table: str, country: str) -> DataFrame:
    """[G06] Rows of the countries configured for a table, with their region."""
    listed = config.filter(F.col("table_name") == table).select(F.col("country").alias(country), "region").distinct()
    return lookup(df, listed, [country], "inner")


def roll_up(df: DataFrame, levels: Sequence[str], amount: str) -> Mapping[str, DataFrame]:
    """[G07] Totals at every level of a hierarchy, from country down; finer levels feed coarser ones.

    Only the finest level reads the data, each other level sums the level below it.
    """
    out: dict[str, DataFrame] = {}
    frame = df
    for depth in range(len(levels), 0, -1):
        frame = frame.groupBy(*levels[:depth]).agg(F.sum(amount).alias(amount))
        out[levels[depth - 1]] = frame
    return out
