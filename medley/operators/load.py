"""Incremental loads over plain Parquet: no table format with transactions is assumed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from typing import Any
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medley.operators.joins import anti, compare_totals, semi
from medley.operators.skew import lookup
from medley.operators.windows import latest
from medley.session import materialise
from medley.sources import snapshots


def mode(load_type: str | None, watermark: Any) -> str:
    """[L01] `full` for load types D and W or without a watermark, else `incremental`."""
    if load_type in ("D", "W") or watermark is None:
        return "full"
    if load_type == "I":
        return "incremental"
    raise ValueError(f"unknown load type {load_type!r}")


def incremental(df: DataFrame, column: str, watermark: Any, by: str = "day") -> DataFrame:
    """[L02] Rows newer than the watermark; no watermark means all rows.

    `day` keeps rows at least one calendar day later, so later rows of the watermark's own day are left
    out; `timestamp` keeps every later row. The day form is a plain comparison with the next midnight,
    which reaches the Parquet scan, where a function of the column would not.
    """
    if watermark is None:
        return df
    if by == "timestamp":
        return df.filter(F.col(column) > F.lit(watermark))
    if by != "day":
        raise ValueError(f"unknown comparison {by!r}")
    day = watermark.date() if isinstance(watermark, dt.datetime) else watermark
    kind = df.schema[column].dataType
    return df.filter(F.col(column) >= F.lit(day + dt.timedelta(days=1)).cast(kind))


def full_slice(
    df: DataFrame, region: tuple[str, str], country: tuple[str, Sequence[str]], record: tuple[str, str, Sequence[str]]
) -> DataFrame:
    """[L03, P10] Rows of a region, without excluded countries, of one record type or an unlisted one."""
    column, keep, others = record
    kind = F.col(column)
    wanted = (kind == keep) | kind.isNull() | ~kind.isin(*others)
    return df.filter((F.col(region[0]) == region[1]) & ~F.col(country[0]).isin(*country[1]) & wanted)


def replace_slice(target: DataFrame, new: DataFrame, predicate: Column) -> DataFrame:
    """[L04] The target without the rows of a slice, plus the new rows. Null does not count as in the slice."""
    return target.filter(~F.coalesce(predicate, F.lit(False))).unionByName(new)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """[L05] Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def merge(
    target: DataFrame, source: DataFrame, key: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    """[L05, L12] Update matched rows, insert the rest: target rows without a source row, plus the source.

    The source must hold one row per key; with `order_by` its newest row per key is taken, without it a
    repeated key is an error. Only the source's keys travel to the target's side of the join; nulls in the
    key match nulls. The chosen rows are written once, as both halves of the result need them.
    """
    if order_by:
        source = materialise(latest(source, key, order_by), "source")
    elif not duplicate_keys(source, key).isEmpty():
        raise ValueError(f"source has several rows for one key {list(key)}")
    renamed = source.select(*[F.col(k).alias(f"_{k}") for k in key])
    hit = F.lit(True)
    for k in key:
        hit = hit & target[k].eqNullSafe(renamed[f"_{k}"])
    return target.join(renamed, hit, "left_anti").unionByName(source)


def merge_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    key: Sequence[str],
    partition: str,
    order_by: Sequence[str] | None = None,
) -> int:
    """[L05] Merge into a partitioned table and rewrite only the partitions that change; how many they are.

    A partition changes if the source has rows for it, or if a key of the source lies in it so far: a key that moves leaves
    its old partition. Those values, the null one included, are listed by a scan of the target's keys and written; the
    target is then read by a semi join on them. The new partitions are written aside and read back before they replace
    the old ones, because a path must not be overwritten while it is read, and partitions left empty are removed.
    """
    source = materialise(latest(source, key, order_by), "source") if order_by else source
    if not order_by and not duplicate_keys(source, key).isEmpty():
        raise ValueError(f"source has several rows for one key {list(key)}")
    target = spark.read.parquet(path)
    source = source.withColumn(partition, F.col(partition).cast(target.schema[partition].dataType))
    moved = lookup(target.select(*key, partition), source.select(*key), key, "left_semi").select(partition)
    touched = materialise(moved.unionByName(source.select(partition)).distinct(), "touched")
    old = lookup(target, touched, [partition], "left_semi")
    new = materialise(merge(old, source, key), "merge")
    overwrite_partitions(new, path, [partition])
    empty = lookup(touched, new.select(partition).distinct(), [partition], "left_anti")
    for row in empty.toLocalIterator():
        remove(spark, f"{path.rstrip('/')}/{partition_folder(partition, row[0])}")
    return touched.count()


def merge_snapshot(
    spark: SparkSession, path: str, source: DataFrame, key: Sequence[str], partition: str, order_by: Sequence[str] | None = None
) -> int:
    """[L05] Merge into a table kept by `snapshots`, and rewrite only the parts that change; how many they are.

    As `merge_partitions`, but readers and later writers see all of it or nothing: a run that is lost leaves the old version,
    and one that another writer overtakes is worked out again on that writer's. The labels of the changed parts, no
    more than the table has parts, come to the driver; no row does.
    """
    source = materialise(latest(source, key, order_by) if order_by else source, "source")
    if not order_by and not duplicate_keys(source, key).isEmpty():
        raise ValueError(f"source has several rows for one key {list(key)}")
    changed = 0

    def change(version: snapshots.Version) -> tuple[T.StructType, snapshots.Folders]:
        nonlocal changed
        target = snapshots.read(spark, path, version=version)
        if target is None:
            folders = snapshots.write_parts(source, path, partition)
            changed = len(folders)
            return snapshots.widened(None, source.schema), folders
        schema = snapshots.widened(version.schema, source.schema)
        moved = lookup(target.select(*key, partition), source.select(*key), key, "left_semi").select(partition)
        label = F.coalesce(F.col(partition).cast("string"), F.lit(""))
        touched = {r[0] for r in moved.unionByName(source.select(partition)).select(label.alias("label")).distinct().toLocalIterator()}
        changed = len(touched)
        old = snapshots.read(spark, path, touched, snapshots.Version(version.number, schema, version.folders))
        new = merge(old, source.select([F.col(f.name) if f.name in source.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]), key)
        return schema, {**{k: f for k, f in version.folders.items() if k not in touched}, **snapshots.write_parts(new, path, partition)}

    snapshots.publish(spark, path, change)
    return changed


def replace_periods(new: DataFrame, path: str, period: str) -> snapshots.Version:
    """[L09] Replace the periods that occur in the new data in a table kept by `snapshots`, all at once; others stay."""
    folders = snapshots.write_parts(new, path, period)
    return snapshots.replace_labels(new.sparkSession, path, lambda label: label in folders, new.schema, folders)


def partition_folder(column: str, value: Any) -> str:
    """The folder name of a partition value, as Spark writes it."""
    text = "__HIVE_DEFAULT_PARTITION__" if value is None or value == "" else str(value)
    special = set('"#%\'*/:=?\\\x7f{[]^') | {chr(i) for i in range(1, 32)}
    return f"{column}=" + "".join(f"%{ord(c):02X}" if c in special else c for c in text)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark reaches."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def vanished(target: DataFrame, source: DataFrame, key: Sequence[str], predicate: Column) -> DataFrame:
    """[L06, J06] Target rows of the slice whose key left the source. A row with a null key never vanishes."""
    return anti(target.filter(predicate).dropna(subset=list(key)), source, key)


def delete_vanished(target: DataFrame, source: DataFrame, key: Sequence[str], predicate: Column) -> DataFrame:
    """[L06] The target without vanished rows."""
    inside = F.coalesce(predicate, F.lit(False))
    for k in key:
        inside = inside & F.col(k).isNotNull()
    return target.filter(~inside).unionByName(semi(target.filter(inside), source, key))


def in_values(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """[L07] Rows whose value is listed in a table."""
    return semi(df, values.select(F.col(values.columns[0]).alias(column)), [column])


def process_log(
    spark: SparkSession, name: str, count: int, config: str, source: str, start: dt.datetime, end: dt.datetime,
    status: str, parent: str | None = None,
) -> DataFrame:
    """[L08] One row for the process log, to be appended."""
    return spark.createDataFrame(
        [(name, count, config, source, start, end, status, parent)],
        "name string, count long, config string, source string, started timestamp, ended timestamp, "
        "status string, parent string",
    )


def replace_period(target: DataFrame, new: DataFrame, period: Sequence[str]) -> DataFrame:
    """[L09] Periods that occur in the new data are replaced, all others kept.

    The distinct periods of the new data are few next to its rows, and only they meet the target.
    """
    return anti(target, new, period).unionByName(new)


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """[L09, S11] Replace only the partitions that occur in the frame.

    Rows are first dealt by partition value, in balanced pieces: a value's rows come from few tasks, and a large value
    still gets several, so there are about as many files as the data needs and not tasks times values.
    """
    writer = df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


def replace_file(df: DataFrame, path: str, day: dt.date, file: str, keep_days: int | None = None) -> None:
    """[Q19] Replace one delivered file's rows in a table of many files, and drop days older than `keep_days`, in one step.

    The table is kept by `snapshots`, a part for each day and file, the name in lower case. A run that is lost leaves the
    table as it was, and runs of different files lose nothing of each other's.
    """
    own = quote(file.lower(), safe="")
    first = day - dt.timedelta(days=keep_days) if keep_days is not None else dt.date.min

    def gone(label: str) -> bool:
        run_day, name = label.split("/")
        return name == own or dt.date.fromisoformat(run_day) < first

    folder = snapshots.write_folder(df, path)
    snapshots.replace_labels(df.sparkSession, path, gone, df.schema, {f"{day}/{own}": folder})


def read_files(spark: SparkSession, path: str) -> DataFrame | None:
    """The table that `replace_file` keeps, all files together; None if there is none yet."""
    return snapshots.read(spark, path)


def checked_overwrite(raw_lines: DataFrame, loaded: DataFrame, path: str) -> int:
    """[L10, C01] Replace a table only if as many rows were loaded as there are raw lines."""
    row = compare_totals(raw_lines, loaded).first()
    if not row["equal"]:
        raise ValueError(f"{row['rows_a']} raw lines, {row['rows_b']} rows loaded")
    loaded.write.mode("overwrite").parquet(path)
    return row["rows_b"]


def stage_append(staging: DataFrame, path: str, prepare: Callable[[DataFrame], DataFrame] = lambda d: d) -> None:
    """[L11] Append prepared staging rows to the main table."""
    prepare(staging).write.mode("append").parquet(path)


def merge_entities(
    targets: Mapping[str, DataFrame], sources: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]],
    order_by: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """[L12, K15] Merge several reporting tables; an entity without new rows keeps its target.

    Ours: the newest source row per key wins, the key of each entity is stated by the caller.
    """
    return {
        name: merge(target, sources[name], keys[name], order_by) if name in sources else target
        for name, target in targets.items()
    }
