"""Fields out of HTML text and the JSON inside it, by regular expression over the whole text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields of a video record inside a page.
VIDEO_SCHEMA = (
    "headline string, `@type` string, dateCreated string, dateModified string, commentCount string, "
    "author struct<name: string, url: string>, "
    "interactionStatistic array<struct<name: string, userInteractionCount: string>>, "
    "comment array<struct<text: string>>"
)

JSON_SCRIPT = r'(?s)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'


def first_group(html: Column, pattern: str) -> Column:
    """First capture of a pattern, null if it does not occur. The page is searched once, the capture is
    taken from the match."""
    return F.regexp_extract(F.regexp_substr(html, F.lit(pattern)), pattern, 1)


def script_json(html: Column) -> Column:
    """[H01] The JSON text of the page's linked-data script."""
    return first_group(html, JSON_SCRIPT)


def video_record(html: Column) -> Column:
    """[H02] The page's video record as a struct."""
    return F.from_json(script_json(html), VIDEO_SCHEMA)


def video_columns(df: DataFrame, html: str, keep: list[str]) -> DataFrame:
    """[H02, H03, H04] Headline, type, dates, author, counters and comment texts of every page."""
    record = df.select(*keep, video_record(F.col(html)).alias("v"))
    return record.select(
        *keep,
        F.col("v.headline").alias("headline"),
        F.col("v.`@type`").alias("kind"),
        F.col("v.dateCreated").alias("created"),
        F.col("v.dateModified").alias("modified"),
        F.col("v.author.name").alias("author_name"),
        F.col("v.author.url").alias("author_url"),
        F.col("v.commentCount").try_cast("long").alias("comments"),
        counter(F.col("v.interactionStatistic"), 0).alias("likes"),
        counter(F.col("v.interactionStatistic"), 1).alias("shares"),
        counter(F.col("v.interactionStatistic"), 2).alias("followers"),
        F.transform("v.comment", lambda c: c["text"]).alias("comment_texts"),
    )


def counter(stats: Column, index: int) -> Column:
    """[H03] Interaction counter by position."""
    return F.get(stats, index)["userInteractionCount"].try_cast("long")


def named_counter(stats: Column, name: str) -> Column:
    """[H03] Interaction counter by name, safer when pages leave counters out."""
    hit = F.filter(stats, lambda s: s["name"] == name)
    return F.get(hit, 0)["userInteractionCount"].try_cast("long")


# An attribute's value in double or single quotes, or bare, as one group of three.
VALUE = r"""(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def start_tags(html: Column, tag: str) -> Column:
    """[H05] The attributes of every start tag of a kind, in page order, as they stand; quoted values may hold any character."""
    return F.regexp_extract_all(html, F.lit(rf"""(?is)<{tag}((?:\s(?:"[^"]*"|'[^']*'|[^"'>])*)?)>"""), 1)


def attribute(attributes: Column, name: str) -> Column:
    """[H05] The value of an attribute, wherever it stands and however it is quoted; null if there is none."""
    pattern = rf"""(?is)^(?:\s+(?!{name}\s*=)[^\s=>"']+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?|\s*/)*\s+{name}\s*=\s*{VALUE}"""
    value = F.concat(*[F.coalesce(F.regexp_extract(attributes, pattern, k), F.lit("")) for k in (1, 2, 3)])
    return F.when(F.rlike(attributes, F.lit(pattern)), value)


def meta_content(html: Column, name: str) -> Column:
    """[H05] Content of the first meta tag of a name or property, attributes in any order; empty if there is none."""
    named = lambda a: F.coalesce(attribute(a, "name"), attribute(a, "property")).eqNullSafe(name) & attribute(a, "content").isNotNull()
    return F.coalesce(attribute(F.get(F.filter(start_tags(html, "meta"), named), 0), "content"), F.lit(""))


def charset(html: Column) -> Column:
    """[H05] Declared character set; empty if there is none."""
    found = F.filter(F.transform(start_tags(html, "meta"), lambda a: attribute(a, "charset")), lambda x: x.isNotNull())
    return F.coalesce(F.get(found, 0), F.lit(""))


def title(html: Column) -> Column:
    """[H05] Page title, whatever attributes its tag has."""
    return first_group(html, r"""(?is)<title(?:\s(?:"[^"]*"|'[^']*'|[^"'>])*)?>(.*?)</title\s*>""")


def links(html: Column) -> Column:
    """[H05] All link targets in page order, wherever `href` stands in the tag."""
    return F.filter(F.transform(start_tags(html, "a"), lambda a: attribute(a, "href")), lambda x: x.isNotNull())


# Numeric features of a track.
TRACK_FEATURES = (
    "danceability", "energy", "key", "loudness", "mode", "speechiness", "instrumentalness",
    "liveness", "valence", "tempo", "duration_ms", "time_signature",
)


def track_rows(df: DataFrame, items: str, keep: list[str]) -> DataFrame:
    """[H08] One row per track of a playlist: artist, album, name, id and the numeric features it has."""
    rows = df.select(*keep, F.explode(items).alias("t"))
    have = set(rows.schema["t"].dataType.fieldNames())
    names = [f for f in ("artist", "album", "track_name", "track_id", *TRACK_FEATURES) if f in have]
    return rows.select(*keep, *[F.col(f"t.{n}").alias(n) for n in names])
