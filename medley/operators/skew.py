"""Running values over groups of any size, and look-ups in tables of one row per key.

A group may hold a third of all rows. `running` never orders a group in one task: the frame is range-partitioned by group
and order, every part is scanned by itself, and each part passes on one row for each of its two outermost groups, the only
ones that can reach into another part. Look-ups are plain equi-joins, whose hot keys are Spark's to split (AQE).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medley.session import materialise

PART = "_part"
TIE = "_tie"
ALL = "_all"


def same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality over (left column, right column) pairs."""
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def one_per_key(table: DataFrame, keys: Sequence[str], what: str = "table") -> DataFrame:
    """The table, failing when it is read if a key occurs twice: such a row would double what looks it up.

    Counted by a map-side aggregate over the table, which is small next to the data.
    """
    rest = [c for c in table.columns if c not in keys]
    repeated = F.raise_error(F.concat(F.lit(f"{what} has several rows for one key of {list(keys)}: "), F.to_json(F.struct(*keys))))
    rows = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(F.lit(1).alias("_one"), *rest)).alias("_row"))
    # the error stands where the row is made, so that no plan can leave it out
    row = F.when(F.col("_n") == 1, F.col("_row")).otherwise(repeated.cast(rows.schema["_row"].dataType))
    return rows.select(*keys, row.alias("_row")).filter("_row._one = 1").select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest])


def lookup(df: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join `df` to a table that holds one row per key, nulls in the keys matching nulls.

    `how` is inner, left, left_semi or left_anti. Spark picks the method from the real size of the table and splits
    partitions of hot keys; `one_per_key` makes sure of the table where the caller cannot.
    """
    for k in keys:
        if df.schema[k].dataType != table.schema[k].dataType:
            raise ValueError(f"key {k} is {df.schema[k].dataType} here and {table.schema[k].dataType} there")
    renamed = table.withColumnsRenamed({k: f"_r{i}" for i, k in enumerate(keys)})
    on = same(df, renamed, [(k, f"_r{i}") for i, k in enumerate(keys)])
    return df.join(renamed, on, how).drop(*[f"_r{i}" for i in range(len(keys))])


@dataclass(frozen=True)
class Split:
    """A frame cut into parts along its groups and order: the column PART says which; TIE tells equal rows apart."""

    frame: DataFrame
    by: list[str]
    order: list[str]


def split_groups(df: DataFrame, by: Sequence[str], order: Sequence[str], parts: int | None = None) -> Split:
    """Range-partition a frame by group and order columns of any type that can be ordered, and write it.

    Borders come from Spark's sample of the whole key, so a part holds about its share whatever one group holds, texts of
    one prefix and copies included: rows that tie on everything are told apart by a running id. Written once, because the
    parts must be the same for everything that reads them. `parts` is for tests; the session's settings decide.
    """
    frame = df.withColumn(TIE, F.monotonically_increasing_id())
    keys = list(by)
    if not keys:
        frame, keys = frame.withColumn(ALL, F.lit(0)), [ALL]
    columns = [F.col(f"`{c}`") for c in (*keys, *order, TIE)]
    ranged = frame.repartitionByRange(*([parts] if parts else []), *columns)
    return Split(materialise(ranged.withColumn(PART, F.spark_partition_id()), "parts"), keys, [*order, TIE])


def running(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    outputs: dict[str, tuple[str, str]],
    parts: int | None = None,
) -> DataFrame:
    """Running values from the first row of a group to the current one, in ascending order.

    `outputs` maps a new column to ("max", col), ("last", col: last non-null), ("count", "*"), ("count", col: non-null),
    ("sum", col) or ("previous", col: value of the row before).
    """
    return scan(split_groups(df, by, order, parts), outputs).frame.drop(PART, TIE, ALL)


def scan(split: Split, outputs: dict[str, tuple[str, str]]) -> Split:
    """One scan over a frame that is already split; several scans share the split, and one shuffle and sort."""
    df, by, order = split.frame, split.by, split.order
    ordered = Window.partitionBy(PART, *by).orderBy(*order)
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = lambda c: F.lit(1) if c == "*" else F.col(c)
    local = {
        "max": lambda c: F.max(c).over(upto),
        "sum": lambda c: F.sum(c).over(upto),
        "last": lambda c: F.last(c, ignorenulls=True).over(upto),
        "count": lambda c: F.count(counted(c)).over(upto),
        "previous": lambda c: F.lag(c).over(ordered),
    }
    out = df.withColumns({name: local[kind](col) for name, (kind, col) in outputs.items()})
    out = out.withColumn("_at_start", F.row_number().over(ordered) == 1)
    at = F.struct(*order)
    total = {
        "max": F.max,
        "sum": F.sum,
        "last": lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)),
        "count": lambda c: F.count(counted(c)),
        "previous": lambda c: F.max_by(F.struct(c), at),
    }
    # only a part's first and last group can go on elsewhere: two rows a part, a number that the settings bound
    group = F.struct(*by)
    edges = df.groupBy(PART).agg(F.min(group).alias("_first"), F.max(group).alias("_last")).withColumnRenamed(PART, "_edge")
    outer = df.join(F.broadcast(edges), F.col(PART) == F.col("_edge")).filter(group.eqNullSafe(F.col("_first")) | group.eqNullSafe(F.col("_last")))
    names = [f"_k{i}" for i in range(len(by))]
    ends = outer.groupBy(*[F.col(k).alias(n) for k, n in zip(by, names, strict=True)], F.col(PART).alias("_p")).agg(
        *[total[kind](col).alias(f"_t_{name}") for name, (kind, col) in outputs.items()]
    )
    before = Window.partitionBy(*names).orderBy("_p")
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    carry = {
        "max": lambda c: F.max(c).over(earlier),
        "sum": lambda c: F.sum(c).over(earlier),
        "last": lambda c: F.last(c, ignorenulls=True).over(earlier),
        "count": lambda c: F.sum(c).over(earlier),
        "previous": lambda c: F.lag(c).over(before),
    }
    carried = ends.select(
        *names, "_p", F.row_number().over(before).alias("_nth"),
        *[carry[kind](f"_t_{name}").alias(f"_c_{name}") for name, (kind, _) in outputs.items()],
    ).filter("_nth > 1").drop("_nth")
    joined = out.join(F.broadcast(carried), (out[PART] == carried["_p"]) & same(out, carried, list(zip(by, names, strict=True))), "left")
    combine = {
        "max": lambda n, _: F.greatest(n, f"_c_{n}"),
        "sum": lambda n, _: F.coalesce(F.col(n) + F.coalesce(f"_c_{n}", F.lit(0)), f"_c_{n}"),
        "last": lambda n, _: F.coalesce(n, f"_c_{n}"),
        "count": lambda n, _: F.col(n) + F.coalesce(f"_c_{n}", F.lit(0)),
        "previous": lambda n, c: F.when(F.col("_at_start"), F.col(f"_c_{n}")[c]).otherwise(F.col(n)),
    }
    merged = joined.withColumns({name: combine[kind](name, col) for name, (kind, col) in outputs.items()})
    return replace(split, frame=merged.select(*[c for c in out.columns if c != "_at_start"]))
