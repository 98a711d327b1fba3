"""Registry of queries: a function over the tables and, where SQL can say it, the same in ANSI SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    """The tables of one directory as attributes, read lazily."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    """A registered query."""

    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, path: str) -> DataFrame:
        return self.build(Tables(spark, path))


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function under its own name."""

    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        REGISTRY[build.__name__] = Query(build, sql)
        return build

    return add


def money(column: str | Column) -> Column:
    """An amount as a decimal with two places: sums are exact and do not depend on their order."""
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(18,2)")


def number(column: Column) -> Column:
    """A decimal result as a double."""
    return column.cast("double")
