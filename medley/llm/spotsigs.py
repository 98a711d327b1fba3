"""SpotSigs document fingerprints, in DataFrame functions only.

An anchor is a very common word. Each place of an anchor gives a spot signature: the anchor with the chain of the next
content words, words that are neither anchors nor other stop words. A word that no anchor stands shortly before gives a
signature of its own, with the words after it as they are, so that no stretch of a text is left out. Both kinds are the same
at every length, and an edit changes no signature but those around it. A document's bag of signatures is its fingerprint.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medley import session

ANCHORS = "the a an is was of der die das ein ist le la les un est el los es que".split()
STOP = (
    "and in to that it for with as at by on be this from are or und von zu mit auf den dem nicht im für sich des sie er es "
    "et de du des une en dans pour par sur au pas qui y del se las por para con no una su al lo"
).split()
CHAIN = 2
SPAN = 6
GROUP = 256


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value worked out once; a lambda that names an expression would work it out again for every element."""
    return F.transform(F.array(value), then).getItem(0)


def mark(anchor: Column, chain: Column) -> Column:
    """The first 12 hex digits of the MD5 of an anchor and its chain."""
    return F.substring(F.md5(F.concat(anchor, F.lit("|"), F.array_join(chain, " "))), 1, 12)


def numbered(marks: Column) -> Column:
    """Sorted marks, a repeated one followed by + and how many equal ones stand before it, so that a set of them is a bag of marks."""

    def of(m: Column) -> Column:
        starts = F.filter(F.transform(m, lambda x, i: F.when((i == 0) | (F.get(m, i - 1) != x), i)), lambda i: i.isNotNull())
        return let(starts, lambda s: let(F.concat(F.slice(s, 2, F.size(s)), F.array(F.size(m))), lambda e: runs(m, s, e)))

    def runs(m: Column, starts: Column, ends: Column) -> Column:
        run = lambda a, b: let(F.get(m, a), lambda x: F.transform(F.sequence(F.lit(0), b - a - 1), lambda k: F.when(k == 0, x).otherwise(F.concat(x, F.lit("+"), k.cast("string")))))
        return F.flatten(F.zip_with(starts, ends, run))

    return F.when(F.size(marks) > 0, let(F.sort_array(marks), of)).otherwise(F.array().cast("array<string>"))


def signatures(text: Column) -> Column:
    """The signatures of a text in order, 12 hex digits each and the number of a repeat; null counts as empty.

    An anchor's chain takes up to CHAIN content words from the SPAN words after it. A word with no anchor among itself and the
    SPAN - 1 words before it takes the next CHAIN words. A text without words has the empty set, any other has a signature.
    """

    def spot(w: Column, i: Column) -> Column:
        chain = F.filter(F.slice(w, i + 2, SPAN), lambda y: ~y.isin(*ANCHORS, *STOP))
        return mark(F.get(w, i), F.slice(chain, 1, CHAIN))

    def found(w: Column, places: Column) -> Column:
        starts, ends = F.concat(F.array(F.lit(-SPAN)), places), F.concat(places, F.array(F.size(w)))
        between = F.zip_with(starts, ends, lambda a, b: F.when(a + SPAN < b, F.sequence(a + SPAN, b - 1)).otherwise(F.array().cast("array<int>")))
        plain = F.transform(F.flatten(between), lambda i: mark(F.get(w, i), F.slice(w, i + 2, CHAIN)))
        return F.concat(F.transform(places, lambda i: spot(w, i)), plain)

    def of(w: Column) -> Column:
        places = F.filter(F.transform(w, lambda x, i: F.when(x.isin(ANCHORS), i)), lambda i: i.isNotNull())
        return let(places, lambda p: found(w, p))

    return let(let(words(F.coalesce(text, F.lit(""))), of), lambda marks: numbered(marks))


def fingerprint(sigs: Column) -> Column:
    """A signature set as text, in order."""
    return F.array_join(sigs, ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets; 1 for two empty ones. The intersection is only looked for where it can be."""
    common = F.size(F.array_intersect(a, b)).cast("double")
    possible = (F.size(a) > 0) & (F.size(b) > 0) & (F.array_min(a) <= F.array_max(b)) & (F.array_min(b) <= F.array_max(a))
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).when(possible, common / (F.size(a) + F.size(b) - common)).otherwise(F.lit(0.0))


def following(ids: DataFrame, column: str) -> DataFrame:
    """Every distinct value of a column with the next greater one; the greatest has the least.

    Values are range-partitioned, so no task orders more than its share; only the partitions' least values meet in one.
    """
    parts = ids.select(column).distinct().repartitionByRange(F.col(column)).select(column, F.spark_partition_id().alias("_part"))
    parts = session.materialise(parts, "order")
    inner = Window.partitionBy("_part").orderBy(column)
    heads = parts.groupBy("_part").agg(F.min(column).alias("_head"))
    # one row for each partition, a count that the session's settings bound
    outer = Window.orderBy("_part")
    heads = heads.select("_part", F.lead("_head").over(outer).alias("_next"), F.min("_head").over(outer).alias("_least"))
    own = parts.withColumn("_own", F.lead(column).over(inner)).join(heads, "_part")
    return own.select(column, F.coalesce("_own", "_next", "_least").alias("next"))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, sigs, next_text and next_sigs: every row beside the next by (doc_id, hash of the text); the last's is the first.

    Rows are dealt by groups of GROUP neighbouring ids and look ahead within them, so the texts are shuffled once; a group's
    last row takes the first row of the next group that has any. A row with a null id has no next one.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = rows.where("doc_id IS NOT NULL").withColumn("_group", F.floor(F.col("doc_id") / GROUP)).withColumn("_hash", F.xxhash64("text"))
    heads = known.groupBy("_group").agg(F.min(F.struct("doc_id", "_hash", "text")).alias("head"))
    heads = session.materialise(heads.select("_group", F.col("head.text").alias("head")), "heads")
    after = following(heads, "_group").select(F.col("_group").alias("_before"), F.col("next").alias("_group"))
    heads = heads.join(after, "_group").select(F.col("_before").alias("_group"), F.col("head").alias("_head"), signatures(F.col("head")).alias("_head_sigs"))
    order = Window.partitionBy("_group").orderBy("doc_id", "_hash")
    # dealt before the signatures are made, which are longer than the texts
    ahead = known.repartition("_group").withColumn("sigs", signatures(F.col("text")))
    ahead = ahead.withColumns({"_text": F.lead("text").over(order), "_sigs": F.lead("sigs").over(order)})
    last = F.col("ahead._text").isNull()
    joined = ahead.alias("ahead").join(heads.alias("heads"), (F.col("ahead._group") == F.col("heads._group")) & last, "left")
    joined = joined.select(
        "doc_id", "text", "sigs", F.coalesce("_text", "_head").alias("next_text"), F.coalesce("_sigs", "_head_sigs").alias("next_sigs")
    )
    lost = rows.where("doc_id IS NULL").select("doc_id", "text", signatures(F.col("text")).alias("sigs"))
    return joined.unionByName(lost.withColumns({"next_text": F.lit(""), "next_sigs": F.array().cast("array<string>")}))


def compare_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness to each other and to the next document's.

    The edited text has its last floor(n_chars / 4) code points replaced by as many of the next document's first (or all).
    Result: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next. A null text counts
    as empty. Rows that repeat an id follow each other by the hash of their
    text. A row with a null id is edited with an empty text.
    """
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - cut), F.substring("next_text", F.lit(1), cut))
    rows = rows.withColumn("edited", edited).withColumn("edited_sigs", signatures(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("sigs")).alias("fingerprint"),
        fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"), likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
    )


def length_partition(size: Column, threshold: float) -> Column:
    """Partition of a set of that size: sets whose Jaccard similarity reaches the threshold lie in the same or neighbouring ones."""
    return F.floor(F.log(F.greatest(size, F.lit(1)).cast("double")) / F.lit(log(1 / threshold)) + 1e-9).cast("int")


def near_pairs(docs: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Membership (doc_id, rep) and links (a, b, near) between representatives whose likeness reaches the threshold.

    Documents of equal fingerprints form one class, whose least id represents it; empty sets, and null ids, are linked with
    nothing. Classes meet under (length partition, signature) of their rarest signatures, of which sets that reach the
    threshold must share one; then lengths, and last the sets, decide.
    """
    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), signatures(F.col("text")).alias("sigs"))
    rows = rows.withColumn("print", F.md5(fingerprint(F.col("sigs"))))
    whole = rows.where(F.size("sigs") > 0).groupBy("print").agg(F.min("doc_id").alias("rep"), F.min("sigs").alias("sigs"))
    whole = session.materialise(whole, "prints")
    member = rows.select("doc_id", "print").join(whole.select("print", "rep"), "print", "left").select("doc_id", F.coalesce("rep", "doc_id").alias("rep"))
    posted = whole.select("rep", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    often = posted.groupBy("sig").agg(F.count("*").alias("freq"))
    rank = F.row_number().over(Window.partitionBy("rep").orderBy("freq", "sig"))
    rare = posted.join(often, "sig").withColumn("at", rank).where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).where("freq > 1")
    rare = rare.withColumn("part", length_partition(F.col("n"), threshold))
    left = rare.select("sig", "part", F.col("rep").alias("a"), F.col("n").alias("na"))
    right = rare.withColumn("part", F.explode(F.array(F.col("part"), F.col("part") - 1))).select("sig", "part", F.col("rep").alias("b"), F.col("n").alias("nb"))
    once = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    reach = once & (F.least("na", "nb") >= F.greatest("na", "nb") * threshold - 1e-9)
    pairs = left.join(right, ["sig", "part"]).where(reach).select("a", "b").distinct()
    one, two = (whole.select(F.col("rep").alias(k), F.col("sigs").alias(f"_{k}")) for k in "ab")
    near = likeness(F.col("_a"), F.col("_b"))
    return member, pairs.join(one, "a").join(two, "b").select("a", "b", near.alias("near")).where(F.col("near") >= threshold)


LIST = {k: ", ".join(f"'{w}'" for w in v) for k, v in (("anchors", ANCHORS), ("stop", STOP))}

SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
o AS (SELECT doc_id, t, coalesce(lead(t) OVER (ORDER BY doc_id), first_value(t) OVER (ORDER BY doc_id)) AS nt,
  coalesce(lead(doc_id) OVER (ORDER BY doc_id), first_value(doc_id) OVER (ORDER BY doc_id)) AS next_id FROM d),
e AS (SELECT *, substr(t, 1, length(t) - length(t) // 4) || substr(nt, 1, length(t) // 4) AS ed FROM o),
w AS (
  SELECT doc_id, k, list_filter(string_split_regex(lower(x), '[^\p{{L}}\p{{N}}]+'), lambda y: y <> '') AS w
  FROM (SELECT doc_id, 1 AS k, t AS x FROM e UNION ALL SELECT doc_id, 2, ed FROM e)),
places AS (SELECT doc_id, k, w, unnest(range(1, len(w) + 1)) AS i FROM w),
known AS (SELECT *, list_contains([{LIST["anchors"]}], w[i]) AS anchor FROM places),
near_anchor AS (SELECT *, bool_or(anchor) OVER (PARTITION BY doc_id, k ORDER BY i ROWS BETWEEN {SPAN - 1} PRECEDING AND CURRENT ROW) AS near_one FROM known),
chains AS (
  SELECT doc_id, k, w[i] AS a, CASE WHEN anchor THEN
    list_filter(w[i+1:i+{SPAN}], lambda y: NOT list_contains([{LIST["anchors"]}, {LIST["stop"]}], y))[1:{CHAIN}] ELSE w[i+1:i+{CHAIN}] END AS c
  FROM near_anchor WHERE anchor OR NOT near_one),
marks AS (SELECT doc_id, k, substr(md5(a || '|' || array_to_string(c, ' ')), 1, 12) AS s FROM chains),
chosen AS (SELECT *, row_number() OVER (PARTITION BY doc_id, k, s) - 1 AS n FROM marks),
sets AS (SELECT doc_id, k, list(s || CASE WHEN n > 0 THEN '+' || n ELSE '' END ORDER BY s, n) AS s FROM chosen GROUP BY doc_id, k),
near AS (
  SELECT e.doc_id, e.t, e.ed, coalesce(a.s, []) AS a, coalesce(b.s, []) AS b, coalesce(c.s, []) AS c FROM e
  LEFT JOIN sets a ON a.doc_id = e.doc_id AND a.k = 1 LEFT JOIN sets b ON b.doc_id = e.doc_id AND b.k = 2
  LEFT JOIN sets c ON c.doc_id = e.next_id AND c.k = 1)
SELECT doc_id, length(t)::BIGINT AS n_chars, sha256(ed) AS edited_sha256, coalesce(array_to_string(a, ','), '') AS fingerprint,
  coalesce(array_to_string(b, ','), '') AS edited_fingerprint,
  CASE WHEN len(a) + len(b) = 0 THEN 1.0 ELSE len(list_intersect(a, b))::DOUBLE / (len(a) + len(b) - len(list_intersect(a, b))) END::DOUBLE AS near_edited,
  CASE WHEN len(a) + len(c) = 0 THEN 1.0 ELSE len(list_intersect(a, c))::DOUBLE / (len(a) + len(c) - len(list_intersect(a, c))) END::DOUBLE AS near_next
FROM near
"""
