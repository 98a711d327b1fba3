"""The training-data pipeline: documents through quality, near-dedup, substring dedup, mixing and tokens.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medley import session
from medley.llm import base, minhash, mixing, quality, sentencepiece, substring

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network does not reject."""
    return quality.judge(docs.select(COLUMNS), base.table(spark, sf_dir, "labels")).where("predicted = 1").select(COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of the least id; shingles of five words, similarity 0.8 or more.

    Rows that repeat an id count as documents of their own where their texts differ; of near copies under the least id the
    one with the least hash stays, of equal rows one. A row without an id is linked with nothing and stays.
    """
    rows = docs.select(COLUMNS)
    known = rows.where("doc_id IS NOT NULL").withColumn("_id", F.xxhash64("doc_id", "text"))
    groups = minhash.near_duplicates(known.select(F.col("_id").alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias("_id"), "component_id").distinct().join(known.select("_id", "doc_id").distinct(), "_id")
    ids = groups.groupBy("component_id").agg(F.min(F.struct("doc_id", "_id")).alias("least")).select("least.*")
    kept = known.join(ids, ["_id", "doc_id"], "left_semi")
    kept = kept.groupBy("_id", "doc_id").agg(F.min(F.struct(COLUMNS[1:])).alias("row")).select("doc_id", "row.*")
    return kept.select(COLUMNS).unionByName(rows.where("doc_id IS NULL"))


def no_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of windows that start earlier; a document that loses all its words goes."""
    rows = substring.remove_repeats(docs.select(COLUMNS)).where("n_removed = 0 OR n_removed < n_words")
    cut = F.col("n_removed") > 0
    n_chars = F.when(cut, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return rows.withColumns({"text": F.when(cut, F.col("kept_text")).otherwise(F.col("text")), "n_chars": n_chars}).select(COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for, in random order."""
    return mixing.mix(docs, mixing.SEED).select(COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their piece ids."""
    return sentencepiece.encode(docs.select(COLUMNS))


STAGES = [
    ("quality classifier", good_quality),
    ("MinHash near-dedup", one_of_each),
    ("substring dedup", no_repeats),
    ("mixing to target weights", mixed),
    ("SentencePiece", tokens),
]

# two stages are neural or a model file's vocabulary, which SQL cannot express; tests/llm compares with a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = base.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = session.materialise(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs


QUERY = base.Query(run, ORACLE_SQL)
