"""Registry of this package's queries, the held-out rule and the bounded training sample."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import log

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medley import session
from medley.llm.grouped import mapped, parts


@dataclass(frozen=True)
class Query:
    """A query over the tables of a directory and, where SQL can say it, the same in DuckDB's SQL."""

    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None

    def __call__(self, spark: SparkSession, path: str) -> DataFrame:
        return self.build(spark, path)


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One of the tables."""
    return spark.read.parquet(f"{path}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4; those rows are never learned from. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def excerpt(text: Column, size: int, pieces: int = 8) -> Column:
    """The text, or of one longer than ``size`` code points as many points in evenly spaced pieces. For training only."""
    piece = size // pieces
    parts = [F.substring(text, F.lit(1) + F.floor((F.length(text) - piece) * F.lit(k / (pieces - 1))).cast("int"), F.lit(piece)) for k in range(pieces)]
    return F.when(F.length(text) <= size, text).otherwise(F.concat_ws(" ", *parts))


def training_sample(docs: DataFrame, labels: DataFrame, bound: int, seed: str, size: int | None = 20_000) -> DataFrame:
    """About ``bound`` rows of each label value (all, where there are fewer), the same for any partitioning.

    ``labels`` holds (doc_id, label). Rows whose label, id or text is null, and held-out rows, are never taken. A row is
    taken if a salted hash of its id, as a number in [0, 1), is under bound / rows of its label. Texts longer than ``size``
    are cut to evenly spaced pieces, so the sample has a proven bound in bytes and may go to one process that fits a model;
    without a ``size`` they stay whole, for labels that hold for a text and not for each part, and only rows are bounded.
    """
    rows = labels.select(F.col("doc_id").alias("doc_id"), F.col("label").alias("label"))
    rows = rows.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    sizes = rows.groupBy("label").agg(F.count("*").alias("_n"))
    chance = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = rows.join(sizes, "label").where(chance < F.lit(float(bound)) / F.col("_n")).select("doc_id", "label")
    chosen = session.materialise(chosen, "sample")
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    taken = F.col("text") if size is None else excerpt(F.col("text"), size)
    return texts.join(F.broadcast(chosen), "doc_id").select("doc_id", taken.alias("text"), "label")


def prior_shift(labels: DataFrame, column: str, sample: object) -> float:
    """What to add to a log-odds fitted to a sample of 0/1 labels so that it holds for all rows that are not held out."""
    known = labels.where(F.col("doc_id").isNotNull() & ~held_out())
    ones, zeros = known.agg(F.count_if(F.col(column) == 1), F.count_if(F.col(column) == 0)).first()
    taken = [int((sample == 1).sum()), int((sample == 0).sum())]
    if not all([ones, zeros, *taken]):
        return 0.0
    return log(ones / zeros) - log(taken[0] / taken[1])


def annotate(docs: DataFrame, column: str, added: dict[str, T.DataType], compute: Callable[[pa.Array], list[pa.Array]]) -> DataFrame:
    """Every row with columns worked out batch by batch from one column; input columns of the new names are replaced."""
    rows = docs.select([c for c in docs.columns if c.lower() not in added])
    at = rows.columns.index(column)
    names = [*rows.columns, *added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, *compute(batch.column(at))], names)

    return mapped(rows, run, T.StructType([*rows.schema.fields, *(T.StructField(k, v) for k, v in added.items())]))
