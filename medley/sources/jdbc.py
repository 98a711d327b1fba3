"""JDBC tables. Needs a driver on the classpath and a server, neither of which is part of this repo."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def read_options(
    url: str, query: str, column: str | None = None, low: Any = None, high: Any = None, parts: int = 8,
    fetch: int = 10_000, **extra: str,
) -> dict[str, str]:
    """[S19] Reader options. With a column and bounds the read is split into ranges, one query each."""
    options = {"url": url, "dbtable": f"({query}) q", "fetchsize": str(fetch), **extra}
    if column is not None:
        options |= {
            "partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(parts)
        }
    return options


def read_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """[S19] A query over JDBC."""
    return spark.read.format("jdbc").options(**options).load()


def write_options(url: str, table: str, batch: int = 10_000, parts: int = 8, **extra: str) -> dict[str, str]:
    """[S20] Writer options: batched inserts over a limited number of connections."""
    return {"url": url, "dbtable": table, "batchsize": str(batch), "numPartitions": str(parts), **extra}


def write_jdbc(df: DataFrame, options: Mapping[str, str], replace: bool = False) -> None:
    """[S20] Append to a table, or replace its rows and keep its definition."""
    writer = df.write.format("jdbc").options(**options)
    (writer.option("truncate", True).mode("overwrite") if replace else writer.mode("append")).save()
