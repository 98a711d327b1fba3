"""Delimited text to typed records in a binary row format."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medley.sources import avro

# Field types accepted, and the Spark type of each.
TYPES = {"string": "string", "boolean": "boolean", "int": "int", "long": "bigint", "float": "float", "double": "double"}


def check_fields(fields: Sequence[tuple[str, str]]) -> None:
    """[S15] Refuse unsupported types before any job starts."""
    bad = [f"{n}: {t}" for n, t in fields if t.lower() not in TYPES]
    if bad:
        raise ValueError(f"unsupported field types {bad}")


def parse_typed(lines: DataFrame, fields: Sequence[tuple[str, str]], delimiter: str = ",", strict: bool = True) -> DataFrame:
    """[S15] Lines cut at a delimiter and cast by position.

    Strict: a text that does not fit its type fails the job, as does a line with too few fields;
    otherwise both give null.
    """
    check_fields(fields)
    parts = F.split("value", "\\Q" + delimiter + "\\E", -1)
    cols = []
    for i, (name, kind) in enumerate(fields):
        text = F.element_at(parts, i + 1) if strict else F.get(parts, i)
        spark_type = TYPES[kind.lower()]
        cols.append((text.cast(spark_type) if strict else text.try_cast(spark_type)).alias(name))
    return lines.select(*cols)


def csv_to_typed(
    spark: SparkSession, path: str, out: str, fields: Sequence[tuple[str, str]], delimiter: str = ",",
    fmt: str = "avro", strict: bool = True,
) -> str:
    """[S15] Typed records, snappy, as Avro or another format of the session; one that is missing is refused. Returns the format."""
    check_fields(fields)
    if fmt != "avro" and not has_format(spark, fmt):
        raise ValueError(f"the session has no format {fmt}")
    rows = parse_typed(spark.read.text(path), fields, delimiter, strict)
    if fmt == "avro":
        avro.write(rows, out)
    else:
        rows.write.mode("overwrite").format(fmt).option("compression", "snappy").save(out)
    return fmt


def read_typed(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """[S16] The records read back."""
    return avro.read(spark, path) if fmt == "avro" else spark.read.format(fmt).load(path)


def has_format(spark: SparkSession, fmt: str) -> bool:
    """True if the session has a data source of that name."""
    empty = spark.createDataFrame([], "a string")
    try:
        spark.read.format(fmt).schema(empty.schema).load([])
    except (AnalysisException, Py4JJavaError):
        return False
    return True
