"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medley import session

PART = 16.0
TERMS = 128


def rates(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5, epochs: float = 1.0) -> DataFrame:
    """Mean repetitions of a document of each source, so that each source's share of the characters meets its target.

    Targets are ``weights`` (sources not named: 0) or, without them, in proportion to (characters of the source) **
    ``temperature``. ``epochs`` is the size of the mixture against the input. A source without any character has rate 1.
    A null source is a source of its own. Result: source, parts and cdf (the Poisson distribution's cumulated values for
    rate / parts; sums of ``parts`` draws keep every mean within 16, where the values do not underflow), rate.
    """
    mass = docs.groupBy(F.col("source").alias("source")).agg(F.sum(F.coalesce(F.length("text"), F.lit(0))).cast("long").alias("mass"))
    if weights is None:
        mass = mass.withColumn("target", F.when(F.col("mass") > 0, F.pow(F.col("mass").cast("double"), F.lit(temperature))).otherwise(F.lit(0.0)))
    else:
        table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
        mass = mass.withColumn("target", F.coalesce(F.try_element_at(table, F.col("source")), F.lit(0.0)))
    totals = mass.agg(F.sum("mass").alias("all_mass"), F.sum("target").alias("all_target"))
    rate = F.when(F.col("mass") == 0, F.lit(1.0)).otherwise(
        F.lit(epochs) * F.col("all_mass") * F.try_divide(F.col("target"), F.col("all_target")) / F.nullif(F.col("mass"), F.lit(0))
    )
    out = mass.crossJoin(totals).select("source", F.coalesce(rate, F.lit(0.0)).alias("rate"))
    out = out.withColumn("parts", F.greatest(F.lit(1.0), F.ceil(F.col("rate") / PART).cast("double")).cast("int"))
    mean = F.col("rate") / F.col("parts")
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.array(F.exp(-mean)).alias("cdf"))

    def step(s: Column, k: Column) -> Column:
        p = s["p"] * F.col("mean") / k
        return F.struct(p.alias("p"), (s["c"] + p).alias("c"), F.concat(s["cdf"], F.array(s["c"] + p)).alias("cdf"))

    terms = F.array(*[F.lit(float(k)) for k in range(1, TERMS)])
    return out.withColumn("mean", mean).select("source", "rate", "parts", F.aggregate(terms, start, step, lambda s: s["cdf"]).alias("cdf"))


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5; null parts count as the text ``null``."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix(docs: DataFrame, seed: str, weights: dict[str, float] | None = None, temperature: float = 0.5, epochs: float = 1.0) -> DataFrame:
    """Every document as often as its draw says, all copies in one global random order.

    The draw inverts the Poisson distribution of the source's rate at a uniform number hashed from seed and doc_id, so a
    rerun or a lost executor gives the same copies; a document drawn 0 times goes. The columns of ``docs`` stay, with
    ``copy`` (from 1) and ``shuffle_key``, by which the result is sorted; input columns of these names are replaced.
    Repeated rows of one id share their draw. The rates table is written first: Spark broadcasts it only if the written
    file is under its threshold, and else joins by shuffle with its skew handling, as one source may hold most rows.
    """
    table = session.materialise(rates(docs, weights, temperature, epochs), "rates").select(
        F.col("source").alias("_source"), F.col("parts").alias("_parts"), F.col("cdf").alias("_cdf")
    )
    # the row travels as one struct, so that no column of it can clash
    keep = F.struct(*[c for c in docs.columns if c.lower() not in ("copy", "shuffle_key")])
    rows = docs.select(keep.alias("_row"))
    drawn = rows.join(table, F.col("_row.source").eqNullSafe(F.col("_source")))
    doc_id = F.col("_row.doc_id")
    # the numbers are an array of their own: a lambda that named one would work it out again for every term
    numbers = F.transform(F.sequence(F.lit(1), F.col("_parts")), lambda part: uniform(F.lit(seed), doc_id, part))
    draws = F.transform(numbers, lambda u: F.size(F.filter("_cdf", lambda c: c <= u)))
    count = F.aggregate(draws, F.lit(0), lambda a, b: a + b)
    each = F.flatten(F.transform(F.array(count), lambda n: F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))))
    copies = drawn.select("_row", F.explode(each).alias("copy"))
    key = F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.col("copy").cast("string")))
    return copies.withColumn("shuffle_key", key).orderBy("shuffle_key", doc_id, "copy").select("_row.*", "copy", "shuffle_key")


SEED = "mix-1"

SQL = f"""
WITH RECURSIVE mass AS (
  SELECT source, sum(coalesce(length(text), 0))::BIGINT AS mass FROM documents GROUP BY source),
targets AS (SELECT *, CASE WHEN mass > 0 THEN pow(mass::DOUBLE, 0.5) ELSE 0 END AS target FROM mass),
rates AS (
  SELECT source, CASE WHEN mass = 0 THEN 1.0
    ELSE (SELECT sum(mass) FROM targets) * (target / (SELECT sum(target) FROM targets)) / mass END AS rate FROM targets),
parts AS (SELECT source, greatest(1, ceil(rate / 16))::INT AS parts, rate / greatest(1, ceil(rate / 16)) AS mean FROM rates),
cdf(source, k, p, c) AS (
  SELECT source, 0, exp(-mean), exp(-mean) FROM parts
  UNION ALL
  SELECT cdf.source, k + 1, p * mean / (k + 1), c + p * mean / (k + 1)
  FROM cdf JOIN parts ON cdf.source IS NOT DISTINCT FROM parts.source WHERE k < {TERMS - 1}),
steps AS (SELECT source, list(c) AS cs FROM cdf GROUP BY source),
draws AS (
  SELECT d.*, p.part, ('0x' || substr(md5('{SEED}|' || coalesce(doc_id::VARCHAR, 'null') || '|' || p.part), 1, 13))::BIGINT::DOUBLE
    / 4503599627370496.0 AS u
  FROM documents d JOIN (SELECT source, unnest(range(1, parts + 1)) AS part FROM parts) p ON d.source IS NOT DISTINCT FROM p.source),
counts AS (
  SELECT doc_id, text, lang, d.source, n_chars, sum(len(list_filter(cs, lambda c: c <= u)))::INT AS n
  FROM draws d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, copy::INT AS copy,
  md5('{SEED}|order|' || coalesce(doc_id::VARCHAR, 'null') || '|' || copy) AS shuffle_key
FROM (SELECT *, unnest(range(1, n + 1)) AS copy FROM counts WHERE n > 0)
"""
