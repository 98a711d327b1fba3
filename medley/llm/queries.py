"""The queries of this package: each operator over its whole table, with its production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medley.llm import base, collocations, embeddings, infill, language, minhash, mixing, pages, quality, rules, sentencepiece, spotsigs, substring, toxicity


def op1(spark: SparkSession, path: str) -> DataFrame:
    """Piece ids of every document and whether they decode to its text."""
    return sentencepiece.round_trip(base.table(spark, path, "documents"))


def op2(spark: SparkSession, path: str) -> DataFrame:
    """Near-duplicates by three-word shingles at 0.85."""
    return minhash.near_duplicates(base.table(spark, path, "documents"), 3, 85)


def op3(spark: SparkSession, path: str) -> DataFrame:
    """Main text of every page."""
    return pages.extract(base.table(spark, path, "pages"))


def op4(spark: SparkSession, path: str) -> DataFrame:
    """Embeddings of equal label linked at a cosine of 0.93."""
    return embeddings.near_duplicates(base.table(spark, path, "embeddings"), embeddings.LEAST)


def op5(spark: SparkSession, path: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    return spotsigs.compare_edits(base.table(spark, path, "documents"))


def op6(spark: SparkSession, path: str) -> DataFrame:
    """Quality of every document."""
    return quality.score(base.table(spark, path, "documents"), base.table(spark, path, "labels"))


def op7(spark: SparkSession, path: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.score(base.table(spark, path, "documents"), base.table(spark, path, "labels"))


def op8(spark: SparkSession, path: str) -> DataFrame:
    """Language of every document."""
    return language.identify(base.table(spark, path, "documents"))


def op9(spark: SparkSession, path: str) -> DataFrame:
    """Documents replicated so that sources weigh as the square root of their size."""
    return mixing.mix(base.table(spark, path, "documents"), mixing.SEED)


def op10(spark: SparkSession, path: str) -> DataFrame:
    """Documents without words of windows that start earlier."""
    kept = substring.remove_repeats(base.table(spark, path, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11(spark: SparkSession, path: str) -> DataFrame:
    """Documents rearranged for filling in the middle, and whether they can be put back."""
    docs = base.table(spark, path, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = infill.fill_in_middle(docs)
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2(infill.restored(), 256).alias("restored_sha256")]
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op12(spark: SparkSession, path: str) -> DataFrame:
    """Counts of every document, and whether it is kept once its lines have been cleaned."""
    docs = base.table(spark, path, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rules.clean(docs).drop("text", "cleaned")


def op13(spark: SparkSession, path: str) -> DataFrame:
    """Collocations of every language."""
    return collocations.collocations(base.table(spark, path, "documents"))


REGISTRY: dict[str, base.Query] = {
    "op1_sentencepiece": base.Query(op1),
    "op2_minhash": base.Query(op2, minhash.SQL),
    "op3_page_text": base.Query(op3),
    "op4_rotation_codes": base.Query(op4, embeddings.SQL),
    "op5_spotsigs": base.Query(op5, spotsigs.SQL),
    "op6_quality_cnn": base.Query(op6),
    "op7_toxicity_gru": base.Query(op7),
    "op8_language_id": base.Query(op8),
    "op9_poisson_mixing": base.Query(op9, mixing.SQL),
    "op10_super_kmers": base.Query(op10, substring.SQL),
    "op11_fenwick_infill": base.Query(op11, infill.SQL),
    "op12_line_rules": base.Query(op12, rules.SQL),
    "op13_collocations": base.Query(op13, collocations.SQL),
}
