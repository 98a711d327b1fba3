"""Set operations and changes of shape."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medley.operators.skew import scan, split_groups
from medley.operators.windows import fingerprint
from medley.session import materialise


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """[T01] Union all by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def stack_tagged(frames: Mapping[str, DataFrame], tag: str = "source", stamp: Column | None = None) -> DataFrame:
    """[T02, C07] Union all with the source's name, and a load time if given."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in frames.items()]
    out = stack(tagged)
    return out if stamp is None else out.withColumn("load_time", stamp)


def stack_loose(frames: Sequence[DataFrame]) -> DataFrame:
    """[T03] Union of frames with different columns; missing ones are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def minus(a: DataFrame, b: DataFrame) -> DataFrame:
    """[T04] Distinct rows of `a` that are not in `b`."""
    return a.subtract(b)


def drop_duplicate_rows(df: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """[T05] The first row by an order column of each set of equal rows.

    Equal rows are found by fingerprint and reduced on the map side to their least row; of rows that tie on the order
    column the one with the least other values stays. Columns must be of types that can be ordered.
    """
    rest = [c for c in df.columns if c != order]
    least = F.min(F.struct(F.col(order), *rest)).alias("_row")
    return df.groupBy(fingerprint(columns).alias("_fp")).agg(least).select(*[F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    """[T07] Wide to long."""
    return df.unpivot(list(ids), list(values), name, value)


def transpose(df: DataFrame, key: str, values: Sequence[str], keys: Sequence[Any], name: str = "column") -> DataFrame:
    """[T08] A small table on its side: one row per value column, one column per key in a stated list."""
    long = df.unpivot([key], list(values), name, "_v")
    return long.groupBy(name).pivot(key, list(keys)).agg(F.first("_v"))


def reindex(df: DataFrame, key: str, keys: Sequence[Any], extra: str, fill: Any, on: Sequence[Any]) -> DataFrame:
    """[T09] Rows for exactly the given keys, with one more column set on some of them.

    The keys are a literal list, so the frame is narrowed to them before the join.
    """
    kind = df.schema[key].dataType
    wanted = df.sparkSession.createDataFrame([(k,) for k in keys], [key]).withColumn(key, F.col(key).cast(kind))
    rows = wanted.join(df.filter(F.col(key).isin(*keys)), key, "left")
    return rows.withColumn(extra, F.when(F.col(key).isin(*on), F.lit(fill)))


def report_rows(df: DataFrame, file: str, line: str, label: str, amount: str, date: str | None = None, parts: int | None = None) -> DataFrame:
    """[W07, T10] Report lines as (date, category, sub_category, details, amount).

    A labelled line without an amount is a header. A header followed by another header is a category, any
    other header a sub-category. Blank lines and lines that start with `Total` are left out, and so are
    lines above the first header. That a header was a category is known at the header below it, so
    one look back and one value carried down say it all; both scans share one shuffle and one sort.
    """
    text = F.trim(F.col(label))
    lines = df.filter(text.isNotNull() & (text != "")).withColumn("_label", text)
    blank = F.col(amount).isNull() | (F.trim(F.col(amount).cast("string")) == "")
    keep = list(dict.fromkeys([file, line, *([date] if date else []), amount]))
    heads = lines.select(*keep, "_label", F.when(blank, F.col("_label")).alias("_head"))
    seen = scan(split_groups(heads, [file], [line], parts), {"_above": ("previous", "_head")})
    marked = seen.frame.withColumn("_category", F.when(F.col("_head").isNotNull(), F.col("_above"))).drop("_above")
    # the second scan reads its input three times, so the first one's result is written, in the parts that it has
    marked = materialise(marked, "marked")
    outputs = {"category": ("last", "_category"), "sub_category": ("last", "_head")}
    carried = scan(replace(seen, frame=marked), outputs).frame
    total = F.startswith(F.lower("_label"), F.lit("total"))
    data = carried.filter(F.col("_head").isNull() & ~total & F.col("sub_category").isNotNull())
    return data.select(file, line, *([date] if date else []), "category", "sub_category", F.col("_label").alias("details"), amount)
