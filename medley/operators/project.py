"""Projections and filters over whole frames."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medley.functions import text
from medley.operators import quantiles
from medley.operators.skew import running


def rename(df: DataFrame, names: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """[P03] Rename by mapping, or all columns by position."""
    return df.withColumnsRenamed(dict(names)) if isinstance(names, Mapping) else df.toDF(*names)


def sanitise_names(df: DataFrame) -> DataFrame:
    """[P04] Every character of a column name that is not a letter or digit becomes `_`."""
    return df.toDF(*[re.sub("[^A-Za-z0-9]", "_", c) for c in df.columns])


def replace_column(df: DataFrame, drop: str, name: str, value: Column) -> DataFrame:
    """[P06] All columns except one, plus its replacement."""
    return df.withColumn("_new", value).drop(drop).withColumnRenamed("_new", name)


def null_tokens(df: DataFrame, tokens: Sequence[str] = text.NULL_TOKENS) -> DataFrame:
    """[P13] Missing-value tokens become null in every text column, in one projection."""
    cols = [
        text.null_token(F.col(f"`{f.name}`"), tokens).alias(f.name)
        if isinstance(f.dataType, T.StringType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*cols)


def in_or_missing(df: DataFrame, column: str, keep: str, exclude: Sequence[str]) -> DataFrame:
    """[P10] Rows equal to `keep`, or null, or not in the excluded list."""
    c = F.col(column)
    return df.filter((c == keep) | c.isNull() | ~c.isin(*exclude))


def stamp(
    df: DataFrame, report_date: dt.date, load_time: dt.datetime, source: str | Column | None = None
) -> DataFrame:
    """[P15] Lineage columns: source, report date, load time. Without a source, the input file's path."""
    origin = F.col("_metadata.file_path") if source is None else F.lit(source)
    return df.select(
        "*",
        origin.alias("source_uri"),
        F.lit(report_date).alias("report_date"),
        F.lit(load_time).alias("load_time"),
    )


def match_patterns(df: DataFrame, column: str, rules: Sequence[tuple[str, str]], out: str = "rule") -> DataFrame:
    """[P17] One row per (row, rule) whose file pattern matches, without regard to case.

    The rules are configuration, so they become one array of conditions per row: no join, and no pairing
    of every row with every rule in memory.
    """
    up = F.upper(F.col(column))
    hits = F.array(*[F.when(up.like(text.like_pattern(p)), F.lit(name)) for name, p in rules])
    return df.withColumn(out, F.explode(F.filter(hits, lambda h: h.isNotNull())))


def row_numbers(df: DataFrame, order: Sequence[str], out: str = "row_number") -> DataFrame:
    """[P18] Dense 1-based positions along a total order, counted part by part."""
    return running(df, [], order, {out: ("count", "*")})


def row_ids(df: DataFrame, out: str = "row_id") -> DataFrame:
    """[P18] A unique id without a shuffle; not dense, and new on every evaluation."""
    return df.withColumn(out, F.monotonically_increasing_id())


def drop_above(df: DataFrame, column: str, limit: float) -> DataFrame:
    """[P19] Rows above the limit removed; rows without a value stay."""
    return df.filter((F.col(column) <= limit) | F.col(column).isNull())


def fill_stat(df: DataFrame, column: str, how: str) -> DataFrame:
    """[P22] Nulls replaced by the column's mean, exact median or mode (smallest value on a tie)."""
    if how == "mean":
        value = df.agg(F.avg(column)).first()[0]
    elif how == "median":
        value = quantiles.quantiles(df, column, [0.5])[0]
    elif how == "mode":
        counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
        top = counts.orderBy(F.desc("_n"), column).first()
        value = top[0] if top else None
    else:
        raise ValueError(f"unknown statistic {how!r}")
    return df if value is None else df.fillna({column: value})


def set_cell(df: DataFrame, key: str, at: Any, column: str, value: Any) -> DataFrame:
    """[P23] One cell updated by key."""
    return df.withColumn(column, F.when(F.col(key) == at, F.lit(value)).otherwise(F.col(column)))


def lookup_labels(df: DataFrame, key: str, labels: Sequence[Any]) -> DataFrame:
    """[P24] Rows whose key is among the labels."""
    return df.filter(F.col(key).isin(*labels))


def map_columns(df: DataFrame, mapping: Sequence[tuple[str | None, str, str]]) -> DataFrame:
    """[J14] A column mapping (source, target, type) as one projection; a missing source is a typed null."""
    have = set(df.columns)
    cols = [
        (F.col(src).cast(kind) if src in have else F.lit(None).cast(kind)).alias(target)
        for src, target, kind in mapping
    ]
    return df.select(*cols)


def by_name(df: DataFrame) -> DataFrame:
    """[O05] Columns in alphabetical order."""
    return df.select(*sorted(df.columns))
