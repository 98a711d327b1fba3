"""Frame-level vectorised Python: batches of rows, and functions over one or two grouped frames whatever a group holds."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from medley.operators.joins import asof
from medley.operators.skew import PART, TIE, lookup, split_groups
from medley.session import materialise

Frame = pd.DataFrame
PART_ROWS = 500_000
HELD_STATES = 10_000
SALTS = 64


def map_batches(df: DataFrame, f: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """[U03] A function over batches of rows, table in and table out; never sees a whole partition."""

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield f(batch)

    return df.mapInPandas(over, schema)


def demean(df: DataFrame, by: list[str], col: str, out: str) -> DataFrame:
    """[U04] Value minus the mean of its group.

    The mean is a map-side aggregate joined back, so that no worker has to hold a whole group, as a grouped-map
    function would. Written first, its size tells Spark how to join, and partitions of hot keys can be split.
    """
    means = materialise(df.groupBy(*by).agg(F.avg(col).alias("_mean")), "means")
    return lookup(df, means, by).withColumn(out, F.col(col) - F.col("_mean")).drop("_mean")


def grouped(df: DataFrame, by: list[str], f: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """[U04] The grouped-map form, for groups that the caller knows to fit a worker: each is held whole by one."""
    return df.groupBy(*by).applyInPandas(f, schema)


def cogrouped_asof(left: DataFrame, right: DataFrame, by: str, at: str, value: str) -> DataFrame:
    """[U05] Two grouped frames side by side, each left row with the last right value at or before its time.

    A cogrouped function would hold both sides of a group in one worker; here the sides are stacked and scanned as in
    `joins.asof`, so a group may have any size.
    """
    return asof(left, right, [by], at, {value: value})


def typed(frame: Frame, schema: T.StructType) -> pa.Table:
    """A frame as an Arrow table of a schema; missing values become null."""
    return pa.Table.from_pandas(frame[schema.names], to_arrow_schema(schema), preserve_index=False)


@dataclass(frozen=True)
class Summary:
    """What a function over a group needs to know of the whole group: a row of `schema`, worked out piece by piece.

    `of` makes it of some rows, `merge` of two summaries, in any order.
    """

    schema: str
    of: Callable[[Frame], Frame]
    merge: Callable[[Frame, Frame], Frame]


def grouped_map(df: DataFrame, by: Sequence[str], summary: Summary, f: Callable[[Frame, Frame], Frame], schema: str) -> DataFrame:
    """[U04] A function over the rows of each group, `f(rows, summary of the whole group)`, where no worker holds a whole group.

    The first pass makes summaries batch by batch, merged within a task, then under a salt, then by group; the second hands
    every batch's rows of a group to `f` with the group's summary, joined back by size. Rows of a group come in pieces, so
    `f` must work row by row given the summary. Null keys are a group. Without rows the result is empty.
    """
    keys, state, out = list(by), T.StructType.fromDDL(summary.schema), T.StructType.fromDDL(schema)
    known = T.StructType([*(df.schema[k] for k in keys), *state.fields])
    columns = df.columns

    def pieces(frame: Frame) -> Iterator[tuple[tuple, Frame]]:
        for key, rows in frame.groupby(keys, dropna=False, sort=False):
            yield tuple(None if pd.isna(k) else k for k in key), rows

    def emitted(held: dict[tuple, Frame]) -> pa.RecordBatch:
        rows = pd.concat([row.assign(**dict(zip(keys, key, strict=True))) for key, row in held.items()], ignore_index=True)
        return typed(rows, known).combine_chunks().to_batches()[0]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Frame] = {}
        for batch in batches:
            for key, rows in pieces(batch.to_pandas()):
                own = summary.of(rows)
                held[key] = summary.merge(held[key], own) if key in held else own
            if len(held) >= HELD_STATES:
                yield emitted(held)
                held = {}
        if held:
            yield emitted(held)

    def merged(table: pa.Table) -> pa.Table:
        frame = table.to_pandas()
        rows = [frame.iloc[[i]][state.names] for i in range(len(frame))]
        return typed(reduce(summary.merge, rows).assign(**{k: frame[k].iloc[0] for k in keys}), known)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, rows in pieces(batch.to_pandas()):
                whole = rows.iloc[[0]][[f"_of_{c}" for c in state.names]].set_axis(state.names, axis=1)
                yield from typed(f(rows[columns], whole), out).to_batches()

    found = df.sortWithinPartitions(*keys).mapInArrow(first, known).withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    found = found.groupBy(*keys, "_salt").applyInArrow(lambda t: merged(t), known).groupBy(*keys).applyInArrow(lambda t: merged(t), known)
    wholes = materialise(found.withColumnsRenamed({c: f"_of_{c}" for c in state.names}), "summaries")
    return lookup(df, wholes, keys).sortWithinPartitions(*keys).mapInArrow(second, out)


@dataclass(frozen=True)
class Carry:
    """What the earlier rows of a group leave to the later ones: at most a row of `schema`.

    `of` makes it of a part's left and right rows, `then` of what came before and a later part's own; either may be empty.
    """

    schema: str
    of: Callable[[Frame, Frame], Frame]
    then: Callable[[Frame, Frame], Frame]


def cogrouped_map(
    left: DataFrame, right: DataFrame, by: Sequence[str], order: Sequence[str], f: Callable[[Frame, Frame, Frame], Frame], schema: str,
    carry: Carry, tie: Sequence[str] = (), rows: int = PART_ROWS,
) -> DataFrame:
    """[U05] A function over two grouped frames side by side, whatever a group holds: `f(left, right, carried)`.

    Both sides are stacked and range-partitioned by group, `order` (columns of both sides) and side, right rows first among
    equals, then `tie` (columns of either side), into parts of about `rows` rows. A group inside one part is handed over
    whole. One that runs through several parts is handed over part by part, in order, each with what the parts before it
    leave (`carry`), one row a part. Rows come sorted; a group that only one side has gets an empty frame for the other; null keys are
    a group.
    """
    keys, state, out = list(by), T.StructType.fromDDL(carry.schema), T.StructType.fromDDL(schema)
    sides = {"_l": left, "_r": right, "_s": left.sparkSession.createDataFrame([], state)}
    names = {p: {c: f"{p}{i}" for i, c in enumerate(d.columns)} for p, d in sides.items()}

    def packed(prefix: str, number: int, columns: Sequence[str]) -> DataFrame:
        d = sides[prefix]
        decide = [(F.col(c) if c in d.columns else F.lit(None)).alias(f"_t{i}") for i, c in enumerate(tie)]
        return d.select(*[F.col(c).alias(f"_k_{c}") for c in columns], F.lit(number).alias("_side"), *decide, *[F.col(c).alias(n) for c, n in names[prefix].items()])

    used = [*keys, *[c for c in order if c not in keys]]
    ties = [f"_t{i}" for i in range(len(tie))]
    stacked = packed("_r", 0, used).unionByName(packed("_l", 1, used), allowMissingColumns=True)
    groups, sequence = [f"_k_{c}" for c in keys], [f"_k_{c}" for c in order]
    split = split_groups(stacked, groups, [*sequence, "_side", *ties], max(1, ceil((left.count() + right.count()) / rows)))
    frame, ordering = split.frame, split.order
    empty = {p: typed(pd.DataFrame(columns=d.columns), d.schema).to_pandas() for p, d in sides.items()}

    def parted(table: pa.Table) -> dict[str, Frame]:
        table = table.sort_by([(c, "ascending") for c in ordering if c in table.column_names]) if len(table) else table
        side = table.column("_side").to_numpy()
        out = {}
        for prefix, number in (("_r", 0), ("_l", 1), ("_s", -1)):
            mine = side == number
            columns = [n for n in names[prefix].values() if n in table.column_names]
            out[prefix] = table.filter(pa.array(mine)).select(columns).to_pandas().set_axis(list(names[prefix]), axis=1) if mine.any() and columns else empty[prefix]
        return out

    left_state = T.StructType([frame.schema[PART], *(frame.schema[g] for g in groups), *state.fields])

    def own(table: pa.Table) -> pa.Table:
        each = parted(table)
        made = carry.of(each["_l"], each["_r"])
        head = table.select([PART, *groups]).slice(0, 1).to_pandas()
        return typed(made.assign(**{c: head[c].iloc[0] for c in (PART, *groups)}), left_state)

    def onward(table: pa.Table) -> pa.Table:
        frame = table.sort_by(PART).to_pandas()
        carried, found = empty["_s"], []
        for i in range(len(frame)):
            row = frame.iloc[[i]]
            if len(carried):
                found.append(carried.assign(**{c: row[c].iloc[0] for c in (PART, *groups)}))
            made = row[state.names] if row["_any"].iloc[0] else empty["_s"]
            carried = carry.then(carried, made.reset_index(drop=True))
        return typed(pd.concat(found, ignore_index=True) if found else pd.DataFrame(columns=left_state.names), left_state)

    # only a part's first and last group can go on in another part
    group = F.struct(*groups)
    edges = frame.groupBy(PART).agg(F.min(group).alias("_first"), F.max(group).alias("_last"))
    outer = frame.join(edges, PART).filter(group.eqNullSafe(F.col("_first")) | group.eqNullSafe(F.col("_last"))).drop("_first", "_last")
    made = outer.groupBy(PART, *groups).applyInArrow(lambda t: own(t), left_state).withColumn("_any", F.lit(True))
    # every part of the group takes part, so that what is carried reaches parts which leave nothing themselves
    present = lookup(outer.select(PART, *groups).distinct(), made, [PART, *groups]).withColumn("_any", F.coalesce("_any", F.lit(False)))
    states = materialise(present.groupBy(*groups).applyInArrow(lambda t: onward(t), left_state), "carried")
    states = states.withColumnsRenamed(names["_s"]).withColumn("_side", F.lit(-1))

    def final(table: pa.Table) -> pa.Table:
        each = parted(table)
        return typed(f(each["_l"], each["_r"], each["_s"]), out)

    whole = frame.drop(*[c for c in frame.columns if c not in {PART, TIE, "_side", *groups, *sequence, *ties, *names["_l"].values(), *names["_r"].values()}])
    return whole.unionByName(states, allowMissingColumns=True).groupBy(PART, *groups).applyInArrow(lambda t: final(t), out)
