"""Quality rules, line first, in DataFrame functions only.

Every line is judged by itself: punctuation, navigation, boilerplate. Lines that fail are taken out, and a text that loses too
many of its words with them is rejected. Some counts over the whole text can reject it before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
MARKS = "!?#*$%&<>~^=_@{}[]\\"
BARS = "|>»«·"
# What menus, notices and licences say.
PHRASES = (
    "all rights reserved", "accept cookies", "cookie policy", "uses cookies", "click here", "copyright (c)", "enable javascript", "javascript is", "licensed under",
    "log in", "lorem ipsum", "permission is hereby granted", "privacy policy", "read more", "sign in", "sign up", "skip to content", "spdx-license-identifier",
    "subscribe to", "terms of service", "terms of use", "without warranties",
)
SENTENCE = rf"""[.!?…。！？]["'”’»)\]]*([{SPACE}]|$)"""
NOTICE = rf"(^|[^A-Za-z])({'|'.join(p.replace('(', '[(]').replace(')', '[)]') for p in PHRASES)})"
SHORT_LINE = 40
LEAST_WORDS = 50
REPEATED = 50
LOST = 40
ADDED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost_words", "base_failed", "kept", "cleaned"]


def words(text: Column) -> Column:
    """Runs of anything but white space."""
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda x: x != "")


def held(text: Column, characters: str) -> Column:
    """How many of a text's code points are among the given ones."""
    return F.length(F.regexp_replace(text, "[^" + "".join(f"\\{c}" if c in "[]\\^&-" else c for c in characters) + "]+", ""))


def with_repeat_words(rows: DataFrame, column: str, out: str, size: int = 3) -> DataFrame:
    """Rows with, in place of an array of words, how many of them lie in windows of ``size`` words that it holds twice or more.

    Windows are compared by a 64-bit hash. If a text has two equal ones, they are sorted with their places, and the distances
    of the places whose hash has an equal neighbour say how many words they cover.
    """
    w, h, pairs = F.col(column), F.col("_hash"), F.col("_pairs")
    count = F.greatest(F.size(w) - (size - 1), F.lit(0))
    rows = rows.withColumn("_hash", F.transform(F.slice(w, 1, count), lambda x, k: F.xxhash64(x, *(F.get(w, k + j) for j in range(1, size))))).drop(column)
    found = F.when(F.size(F.array_distinct(h)) < F.size(h), F.transform(h, lambda x, k: F.struct(x.alias("h"), k.alias("at"))))
    rows = rows.withColumn("_pairs", F.sort_array(found)).drop("_hash")
    twin = lambda x, k: x["h"].eqNullSafe(F.get(pairs, k - 1)["h"]) | x["h"].eqNullSafe(F.get(pairs, k + 1)["h"])
    rows = rows.withColumn("_places", F.sort_array(F.transform(F.filter(pairs, twin), lambda x: x["at"]))).drop("_pairs")
    covered = lambda p, k: F.least(F.coalesce(F.get("_places", k + 1) - p, F.lit(size)), F.lit(size))
    total = F.aggregate(F.transform("_places", covered), F.lit(0), lambda total, x: total + x)
    return rows.withColumn(out, F.coalesce(total, F.lit(0))).drop("_places")


def line_passes(line: Column, n: Column) -> Column:
    """Whether a line of n words stays: a line without words does, others if no rule fails.

    Punctuation: some word ends a sentence, and emphasis or symbols are no more than one for two words. Navigation: bars and
    arrows are fewer than one for five words. Boilerplate: a line of at most SHORT_LINE words holds none of PHRASES.
    """
    sentence = F.rlike(line, F.lit(SENTENCE))
    notice = (n <= SHORT_LINE) & F.rlike(line, F.lit(f"(?i){NOTICE}"))
    return (n == 0) | (sentence & (held(line, MARKS) * 2 <= n) & (held(line, BARS) * 5 < n) & ~notice)


def clean(docs: DataFrame, lost: int = LOST) -> DataFrame:
    """Every row with the counts of ADDED, base_failed, kept, and cleaned, its text without the lines that fail.

    base_failed: fewer than LEAST_WORDS words, or more than REPEATED of 100 words in three-word windows that occur again. kept:
    not so, and the failing lines hold at most ``lost`` of 100 words. A null text counts as empty and fails. Input columns of
    the new names are replaced; all others, whatever their names, go through. Every row is judged by itself.
    """
    given = [c for c in docs.columns if c.lower() not in ADDED]
    rows = docs.select(F.struct(*given).alias("_row"), F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    rows = rows.withColumn("_each", F.transform(F.split("_text", "\n"), lambda x: F.struct(x.alias("line"), words(x).alias("w"))))
    judged = F.transform("_each", lambda x: F.struct(x["line"].alias("line"), F.size(x["w"]).alias("n"), line_passes(x["line"], F.size(x["w"])).alias("stays")))
    rows = rows.withColumns({"_words": F.flatten(F.transform("_each", lambda x: x["w"])), "_judged": judged})
    filled = F.transform(F.filter("_judged", lambda x: x["n"] > 0), lambda x: x["line"])
    counts = {
        "n_words": F.size("_words"), "word_chars": F.length(F.array_join("_words", "")), "n_symbols": held(F.col("_text"), SYMBOLS),
        "n_dup_lines": F.size(filled) - F.size(F.array_distinct(filled)),
        "n_lost_words": F.aggregate(F.filter("_judged", lambda x: ~x["stays"]), F.lit(0), lambda total, x: total + x["n"]),
    }
    cleaned = F.array_join(F.transform(F.filter("_judged", lambda x: x["stays"]), lambda x: x["line"]), "\n")
    rows = rows.select("_row", "_words", *(v.cast("long").alias(k) for k, v in counts.items()), cleaned.alias("cleaned"))
    rows = with_repeat_words(rows, "_words", "n_repeat_words").withColumn("n_repeat_words", F.col("n_repeat_words").cast("long"))
    rows = rows.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words")))
    rows = rows.withColumn("kept", ~F.col("base_failed") & (100 * F.col("n_lost_words") <= lost * F.col("n_words")))
    return rows.select(*(F.col("_row")[c].alias(c) for c in given), *ADDED)


def quoted(characters: str) -> str:
    return "'" + characters.replace("'", "''") + "'"


SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '[{SPACE}]+'), lambda x: x <> '') AS w,
    string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
windows AS (
  SELECT doc_id, i, w[i:i + 2] AS three FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, three) > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id),
line AS (
  SELECT doc_id, line, len(list_filter(string_split_regex(line, '[{SPACE}]+'), lambda x: x <> '')) AS n,
    translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS small
  FROM (SELECT doc_id, unnest(lines) AS line FROM d)),
judged AS (
  SELECT *, n = 0 OR (regexp_matches(line, {quoted(SENTENCE)})
    AND 2 * (length(line) - length(translate(line, {quoted(MARKS)}, ''))) <= n AND 5 * (length(line) - length(translate(line, {quoted(BARS)}, ''))) < n
    AND NOT (n <= {SHORT_LINE} AND regexp_matches(small, '{NOTICE}'))) AS stays FROM line),
l AS (
  SELECT doc_id, sum(n)::BIGINT AS n_words, count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines,
    coalesce(sum(n) FILTER (NOT stays), 0)::BIGINT AS n_lost_words FROM judged GROUP BY doc_id),
f AS (
  SELECT doc_id, n_words, length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS word_chars,
    length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols, n_dup_lines, coalesce(n, 0) AS n_repeat_words, n_lost_words,
    n_words < {LEAST_WORDS} OR 100 * coalesce(n, 0) > {REPEATED} * n_words AS base_failed
  FROM d JOIN l USING (doc_id) LEFT JOIN repeated USING (doc_id))
SELECT *, NOT base_failed AND 100 * n_lost_words <= {LOST} * n_words AS kept FROM f
"""
