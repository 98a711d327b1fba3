"""Vectorised Python, for logic that column expressions cannot state. Batches arrive through Arrow."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.LongType())
def plus_one(s: pd.Series) -> pd.Series:
    """[U01] A scalar vectorised function."""
    return s + 1


def register(spark: SparkSession, name: str = "add_one") -> str:
    """[U02] Register the vectorised function for SQL and selectExpr."""
    spark.udf.register(name, plus_one)
    return name


def error_text(subject: Column, column: Column) -> Column:
    """[U06] `subject` if it has a colon, else `subject: column`. An expression, not a Python function."""
    return F.when(F.instr(subject, ":") > 0, subject).otherwise(F.concat(subject, F.lit(": "), column))
