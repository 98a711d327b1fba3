"""Fields out of pages and nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medley.functions import text, web
from medley.operators.reshape import stack_tagged
from medley.plans.base import Tables, query


@query("""
SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, regexp_extract(html, '<meta[^>]*charset="([^"]*)"', 1) AS charset,
 regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang FROM pages
""")
def html_title_meta(t: Tables) -> DataFrame:
    """[H05] Title, character set and language."""
    html = F.col("html")
    return t.pages.select(
        "page_id",
        web.title(html).alias("title"),
        web.charset(html).alias("charset"),
        web.first_group(html, '<html lang="([^"]*)"').alias("lang"),
    )


@query("""
SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS link FROM pages
""")
def page_links(t: Tables) -> DataFrame:
    """[H05, X20] One row per link."""
    return t.pages.select("page_id", F.explode(web.links(F.col("html"))).alias("link"))


def video_pages(t: Tables) -> DataFrame:
    """Pages with a video record in a linked-data script, derived row by row from the page itself."""
    number = lambda c: c.cast("string")
    stat = lambda name, value: F.struct(F.lit(name).alias("name"), number(value).alias("userInteractionCount"))
    key = F.col("page_id")
    record = F.struct(
        F.col("url").alias("headline"),
        F.lit("VideoObject").alias("@type"),
        F.lit("2024-01-01").alias("dateCreated"),
        F.lit("2024-02-01").alias("dateModified"),
        number(key * 2).alias("commentCount"),
        F.struct(F.concat(F.lit("author "), number(key)).alias("name"), F.col("url").alias("url")).alias("author"),
        F.array(stat("likes", key), stat("shares", key + 1), stat("followers", key + 2)).alias("interactionStatistic"),
        F.array(F.struct(F.concat(F.lit("first "), number(key)).alias("text")), F.struct(F.lit("second").alias("text"))).alias("comment"),
    )
    script = F.concat(F.lit('<script type="application/ld+json" nonce="a">\n'), F.to_json(record), F.lit("\n</script></body>"))
    planted = F.replace(F.col("html"), F.lit("</body>"), script)
    closed = F.when(F.contains("html", F.lit("</body>")), planted).otherwise(F.concat("html", script))
    return t.pages.select("page_id", "url", closed.alias("html"))


@query("""
SELECT page_id, url AS headline, 'VideoObject' AS kind, '2024-01-01' AS created, '2024-02-01' AS modified, 'author ' || CAST(page_id AS VARCHAR) AS author_name,
 url AS author_url, page_id * 2 AS comments, page_id AS likes, page_id + 1 AS shares, page_id + 2 AS followers,
 'first ' || CAST(page_id AS VARCHAR) || '|second' AS texts FROM pages
""")
def video_records(t: Tables) -> DataFrame:
    """[H01, H02, H03, H04, X23] Video records out of page scripts."""
    rows = web.video_columns(video_pages(t), "html", ["page_id"])
    return rows.withColumn("texts", F.array_join("comment_texts", "|")).drop("comment_texts")


@query("""
SELECT page_id, page_id + 1 AS shares, pos, CASE pos WHEN 0 THEN 'first ' || CAST(page_id AS VARCHAR) ELSE 'second' END AS comment
FROM pages, (VALUES (0), (1)) p(pos)
""")
def video_comments(t: Tables) -> DataFrame:
    """[H03, H04] Comments as rows; a counter by name."""
    rows = video_pages(t).select("page_id", web.video_record(F.col("html")).alias("v"))
    named = rows.withColumn("shares", web.named_counter(F.col("v.interactionStatistic"), "shares"))
    return named.select("page_id", "shares", F.posexplode("v.comment.text").alias("pos", "comment"))


@query("""
SELECT 'orders' AS platform, count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS n, CAST(sum(CASE WHEN o_orderstatus <> 'P' THEN o_custkey + 1000 END) AS DOUBLE) AS total FROM orders
UNION ALL SELECT 'parts', count(*), CAST(sum(p_size) AS DOUBLE) FROM part
""")
def platform_totals(t: Tables) -> DataFrame:
    """[H06, T03] Scraped numbers as text, cast where they are numbers, compared by platform."""
    shown = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.format_number(F.col("o_custkey") + 1000, 0))
    both = stack_tagged(
        {"orders": t.orders.select(shown.alias("views")), "parts": t.part.select(F.concat(F.lit(" "), F.col("p_size").cast("string")).alias("views"))},
        "platform",
    )
    value = text.quoted_number(F.col("views"))
    return both.groupBy("platform").agg(F.count(value).alias("n"), F.sum(value).alias("total"))


@query("""
SELECT c_nationkey AS playlist, c_name AS artist, c_mktsegment AS track_name, c_custkey AS track_id, c_acctbal AS energy FROM customer
""")
def playlist_tracks(t: Tables) -> DataFrame:
    """[H08] Tracks of playlists as feature rows."""
    track = F.struct(
        F.col("c_name").alias("artist"), F.col("c_mktsegment").alias("track_name"), F.col("c_custkey").alias("track_id"),
        F.col("c_acctbal").alias("energy"), F.lit("x").alias("unused"),
    )
    rows = t.customer.select(F.col("c_nationkey").alias("playlist"), F.array(track).alias("items"))
    return web.track_rows(rows, "items", ["playlist"])
