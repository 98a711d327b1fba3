"""Plain files in and out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Schema = T.StructType | str


def read_csv(spark: SparkSession, path: str, schema: Schema | None = None, header: bool = True, **options: str) -> DataFrame:
    """[S01, S14] Delimited text. With a schema no data is read to infer one."""
    reader = spark.read.option("header", header).options(**options)
    return (reader.schema(schema) if schema else reader).csv(path)


def write_csv(df: DataFrame, path: str, header: bool = True, **options: str) -> None:
    """[S02] Delimited text."""
    df.write.mode("overwrite").option("header", header).options(**options).csv(path)


def write_single_file(df: DataFrame, path: str, fmt: str = "csv", most: int = 1_000_000) -> None:
    """[S03] One output file, written by one task: for results that are small by nature; more than `most` rows are refused."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows for one file")
    df.coalesce(1).write.mode("overwrite").format(fmt).option("header", True).save(path)


def write_quoted(df: DataFrame, path: str, delimiter: str = ",", quote: str = '"') -> None:
    """[S04, P21] Every field quoted, null texts blank."""
    write_csv(df.fillna(""), path, sep=delimiter, quote=quote, quoteAll="true")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """[S05, S06] Parquet, ORC or any format by name."""
    return spark.read.format(fmt).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """[S05, S06] Parquet, ORC or any format by name."""
    df.write.format(fmt).mode(mode).save(path)


def read_json_lines(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    """[S07] One JSON object per line."""
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def read_json_multiline(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    """[S08] JSON documents that span lines; a file is read by one task, so files must be modest."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet") -> None:
    """[S09] A directory per value, its rows dealt in balanced pieces: few files each, and several for a value with most rows."""
    df.hint("rebalance", *by).write.mode("overwrite").format(fmt).partitionBy(*by).save(path)


def write_n_files(df: DataFrame, path: str, n: int, fmt: str = "parquet") -> None:
    """[S10] A stated number of files."""
    df.repartition(n).write.mode("overwrite").format(fmt).save(path)


def export_ndjson(df: DataFrame, path: str) -> None:
    """[S17] JSON lines."""
    df.write.mode("overwrite").json(path)


def export_csv_dated(df: DataFrame, prefix: str, date: dt.date) -> str:
    """[S18] CSV under a path that ends in the run date; returns the path."""
    path = f"{prefix}{date:%Y%m%d}"
    write_csv(df, path)
    return path


def frame_from(spark: SparkSession, rows: Sequence, schema: Schema) -> DataFrame:
    """[S21] A frame from literal rows, tuples, mappings or none, with an explicit schema."""
    return spark.createDataFrame(list(rows), schema)


def archive_by_date(df: DataFrame, path: str, date: dt.date) -> None:
    """[S23] A copy under Year=/Month=/Day=; only that day's folder is replaced."""
    parts = {"Year": F.lit(date.year), "Month": F.lit(date.month), "Day": F.lit(date.day)}
    writer = df.withColumns(parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*parts).parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """[S25] A view for SQL."""
    df.createOrReplaceTempView(name)
    return df
