"""Landing areas: raw files of a day into a table, and results routed to their places."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medley.operators.load import overwrite_partitions
from medley.session import materialise

CORRUPT = "_corrupt_record"


def _schema(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def read_ndjson_day(spark: SparkSession, path: str, schema: T.StructType | str, day: dt.date) -> DataFrame:
    """[S11] JSON lines by schema, unknown fields dropped, with the day they belong to."""
    return spark.read.schema(schema).json(path).withColumn("report_date", F.lit(day))


def load_ndjson(spark: SparkSession, path: str, schema: T.StructType | str, day: dt.date, table: str) -> None:
    """[S11] A day's JSON lines into its partition, which is replaced. Any number of entities, one call each."""
    overwrite_partitions(read_ndjson_day(spark, path, schema, day), table, ["report_date"])


def load_ndjson_append(spark: SparkSession, path: str, schema: T.StructType | str, day: dt.date, table: str) -> None:
    """[S12] As `load_ndjson`, rows added to what the partition holds."""
    read_ndjson_day(spark, path, schema, day).hint("rebalance").write.mode("append").partitionBy("report_date").parquet(table)


def load_tolerant(spark: SparkSession, path: str, schema: T.StructType | str, max_bad: int = 25) -> DataFrame:
    """[S13] JSON lines with at most `max_bad` malformed ones left out; more are an error.

    The parsed rows are written once, so that counting bad lines does not parse everything twice.
    """
    full = _schema(schema).add(CORRUPT, "string")
    parsed = spark.read.schema(full).option("columnNameOfCorruptRecord", CORRUPT).json(path)
    kept = materialise(parsed, "tolerant")
    bad = kept.filter(F.col(CORRUPT).isNotNull()).limit(max_bad + 1).count()
    if bad > max_bad:
        raise ValueError(f"more than {max_bad} malformed rows in {path}")
    return kept.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def route_by_key(df: DataFrame, key: str, path: str, special: Sequence[str] = ("error", "report")) -> None:
    """[S22] Rows of the special keys to a directory each, all others to a directory per key.

    Special outputs are made distinct, as reports of one request may arrive more than once.
    """
    for name in special:  # a filter each, which reaches the scan
        df.filter(F.col(key) == name).distinct().write.mode("overwrite").json(f"{path}/{name}")
    rest = df.filter(~F.col(key).isin(*special) | F.col(key).isNull())
    rest.hint("rebalance", key).write.mode("overwrite").partitionBy(key).json(f"{path}/data")


def split_to_tables(df: DataFrame, column: str, path: str) -> None:
    """[S24] One directory per value of a column, written in a single job."""
    df.hint("rebalance", column).write.mode("overwrite").partitionBy(column).parquet(path)


def unprocessed(files: DataFrame, log: DataFrame, name: str = "file_name") -> DataFrame:
    """[S26] Listed files whose names are not in the process log."""
    return files.join(log.select(name).distinct(), name, "left_anti")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """[S26, S28] Paths and sizes of the files below a directory, without their content."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return listing.select(F.col("path").alias("file_name"), "length", "modificationTime")


def read_if_any(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "json") -> DataFrame:
    """[S28] The files of a directory, or an empty frame with the schema if there are none."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(location) or not len(system.listStatus(location)):
        return spark.createDataFrame([], _schema(schema))
    return spark.read.schema(schema).format(fmt).load(path)


def create_table_if_missing(spark: SparkSession, name: str, schema: str, by: Sequence[str] = ()) -> None:
    """[S27] An empty table, unless it is there."""
    parts = f" PARTITIONED BY ({', '.join(by)})" if by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet{parts}")


def drop_staging(spark: SparkSession, name: str) -> None:
    """[S27] Remove a run's staging view and table."""
    spark.catalog.dropTempView(name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """[A20] Raw text lines with the path of their file."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"))
