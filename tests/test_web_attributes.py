from html.parser import HTMLParser

from pyspark.sql import functions as F

from medley.functions import web

PAGES = [
    """<html><head><title lang="en">One &amp; two</title><meta content='a "b"' name=author><META CHARSET=utf-8></head>
    <a class="x" href='/one'>1</a><A HREF="/two?a=b>c" id=k>2</A><a data-href="/no" href=/three>3</a><a name="href">4</a><abbr href="/no">x</abbr></html>""",
    """<title>
 Lines </title ><meta property="og:title" content="T"><meta name="author"><meta name='author' content=""><a
    href = "/spaced"
    >5</a><a href="">6</a><a>7</a>""",
    "", "no tags < a href='x'>", "<a href='/a' href='/b'><a title=\"href='/no'\" href='/yes'>",
]


class Plain(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.links, self.metas = [], []

    def handle_starttag(self, tag, attrs):
        found = {}
        for k, v in attrs:
            found.setdefault(k, v)
        if tag == "a" and found.get("href") is not None:
            self.links.append(found["href"])
        if tag == "meta":
            self.metas.append(found)


def plain(page):
    p = Plain()
    p.feed(page)
    return p


def test_links_and_metas_equal_a_plain_parser(spark):
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(PAGES)], "i int, html string")
    out = rows.select("i", web.links(F.col("html")).alias("links"), web.meta_content(F.col("html"), "author").alias("author"), web.charset(F.col("html")).alias("charset"), web.title(F.col("html")).alias("title"))
    for r in out.collect():
        want = plain(PAGES[r.i])
        assert r.links == want.links
        assert r.author == next((m["content"] for m in want.metas if m.get("name") == "author" and m.get("content") is not None), "")
        assert r.charset == next((m["charset"] for m in want.metas if "charset" in m), "")
    assert [r.title for r in out.orderBy("i").collect()][:2] == ["One &amp; two", "\n Lines "]


def test_links_of_all_pages_equal_a_plain_parser(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in rows.select("html", web.links(F.col("html")).alias("links")).collect():
        assert r.links == plain(r.html).links
