"""Windowed operators, each in a form that survives a group with a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medley.operators.skew import ALL, PART, TIE, lookup, running, scan, split_groups
from medley.session import materialise


def fingerprint(columns: Sequence[str]) -> Column:
    """SHA-256 of a row's values, so that long texts need not travel to be compared.

    Every value carries a null marker and its length, hence two different rows cannot read the same.
    """
    parts = []
    for name in columns:
        value = F.col(f"`{name}`").cast("string")
        parts.append(F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("n")))
    return F.sha2(F.concat_ws("|", *parts), 256)


def mark_duplicate_rows(
    df: DataFrame, order: Sequence[str], columns: Sequence[str] | None = None, parts: int | None = None, keep: Sequence[str] | None = None
) -> DataFrame:
    """[W01, T05] `_dup_n`: number of the row among rows equal in `columns`, in the given order.

    Of the columns only those of `keep` (all, if not given) and the order travel; long texts that are compared can stay behind.
    """
    data = list(columns or [c for c in df.columns if c not in order])
    marked = df.withColumn("_fp", fingerprint(data))
    if keep is not None:
        marked = marked.select(*dict.fromkeys([*keep, *order]), "_fp")
    return running(marked, ["_fp"], list(order), {"_dup_n": ("count", "*")}, parts).drop("_fp")


def count_keys(df: DataFrame, keys: Sequence[str], out: str = "_key_n") -> DataFrame:
    """[W02] How many rows share the row's key; a null key is a group like any other.

    Only keys that repeat are counted out and joined back, rows of unique keys get 1. The counts are written
    first: read from a table, their size tells Spark how to join, and partitions of hot keys can be split.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) > 1)
    counts = materialise(repeated, "counts")
    return lookup(df, counts, keys).withColumn(out, F.coalesce(F.col(out), F.lit(1)))


def rank_in(df: DataFrame, by: Sequence[str], order: str, out: str = "rank", parts: int | None = None) -> DataFrame:
    """[W03] Dense rank of a value within its group.

    A rank is the number of rows so far whose value differs from the one before; both scans share one split.
    """
    seen = scan(split_groups(df, by, [order], parts), {"_before": ("previous", order), "_n": ("count", "*")})
    new = (F.col("_n") == 1) | ~F.col("_before").eqNullSafe(F.col(order))
    ranked = scan(replace(seen, frame=seen.frame.withColumn("_new", F.when(new, 1))), {out: ("count", "_new")})
    return ranked.frame.drop("_before", "_n", "_new", PART, TIE, ALL)


def first_ranks(df: DataFrame, by: Sequence[str], order: str, most: int, out: str = "rank") -> DataFrame:
    """[W03] Rows whose dense rank in their group is ``most`` at most; Spark's window group limit drops others before the shuffle."""
    ranked = df.withColumn(out, F.dense_rank().over(Window.partitionBy(*by).orderBy(order)))
    return ranked.filter(F.col(out) <= most)


def latest(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """[W04, K10] The newest row of each key by the order columns, the first of them deciding first.

    Spark limits each map task to one row per key before the shuffle (window group limit), so a hot key
    arrives as one row per task. Rows tied on all order columns: any one of them.
    """
    newest = Window.partitionBy(*key).orderBy(*[F.desc(o) for o in order])
    return df.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")


def running_max(df: DataFrame, by: Sequence[str], order: Sequence[str], column: str, out: str, parts: int | None = None) -> DataFrame:
    """[W05] Cumulative maximum."""
    return running(df, by, order, {out: ("max", column)}, parts)


def first_date(df: DataFrame, key: str, at: str, out: str) -> DataFrame:
    """[W06] First date per key. Ours: the smallest non-null date."""
    return df.groupBy(key).agg(F.min(at).alias(out))


def carry_header(df: DataFrame, by: Sequence[str], line: str, header: Column, out: str = "section", parts: int | None = None) -> DataFrame:
    """[W07] A section header carried down to the lines below it, within one file."""
    return running(df.withColumn("_h", header), by, [line], {out: ("last", "_h")}, parts).drop("_h")
