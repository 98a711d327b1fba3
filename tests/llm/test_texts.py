"""Tokens, pages, mixing and the pipeline."""

import random
import struct
from pathlib import Path

import numpy as np
import pytest
from plain import near_groups, without_repeats
from pyspark.sql import functions as F

import corpus_pipeline
from medley import session
from medley.llm import mixing, pages, quality, queries, sentencepiece

PATH = "/root/testdata/sf0.001"


def field(number, kind, value):
    head = bytes([number << 3 | kind])
    return head + (bytes([len(value)]) + value if kind == 2 else value)


def model(pieces, byte_fallback, dummy=True):
    data = b""
    for text, score, kind in pieces:
        data += field(1, 2, field(1, 2, text.encode()) + field(2, 5, struct.pack("<f", score)) + field(3, 0, bytes([kind])))
    if byte_fallback:
        data += b"\x12\x03" + b"\x98\x02\x01"
    return sentencepiece.Model(data + field(3, 2, field(3, 0, bytes([dummy])) + field(4, 0, b"\0")))


def best_score(m, text):
    """Best total score of any segmentation, by trying every end and start."""
    table = {p: s for p, s, k in zip(m.pieces, m.scores, m.kinds, strict=True) if k == sentencepiece.NORMAL}
    unknown = min(table.values()) - sentencepiece.UNKNOWN_PENALTY
    best = [0.0] + [-np.inf] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            part = text[start:end]
            if part in table:
                best[end] = max(best[end], best[start] + table[part])
            elif end - start == 1:
                best[end] = max(best[end], best[start] + unknown)
    return best[-1]


@pytest.mark.parametrize("byte_fallback", [False, True])
@pytest.mark.parametrize("long", [64, 0])
def test_segmentation_has_the_best_score(monkeypatch, byte_fallback, long):
    monkeypatch.setattr(sentencepiece, "LONG", long)  # 0 sends every word through the pass for single words
    rng = random.Random(7)
    letters = "abcé▁"
    own = {"".join(rng.choice(letters) for _ in range(rng.randrange(1, 5))) for _ in range(40)}
    pieces = [("<unk>", 0.0, 2)] + ([(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if byte_fallback else [])
    pieces += [(p, -rng.random() * 5 - 0.1, 1) for p in sorted(own)]
    m = model(pieces, byte_fallback)
    assert m.byte_fallback == byte_fallback
    texts = ["".join(rng.choice("abcé zß") for _ in range(rng.randrange(30))) for _ in range(200)]
    unknown = min(s for _, s, k in pieces if k == 1) - sentencepiece.UNKNOWN_PENALTY
    for text, ids in zip(texts, sentencepiece.encode_texts(m, texts), strict=True):
        shown = sentencepiece.normalise(m, text)
        raw = b"".join(bytes([int(m.pieces[i][1:-1], 16)]) if m.kinds[i] == 6 else m.pieces[i].encode() for i in ids if m.kinds[i] != 2)
        if byte_fallback:
            assert raw.decode() == shown
            lost = sum(1 for i in ids if m.kinds[i] == 6 and int(m.pieces[i][1:-1], 16) & 0xC0 != 0x80)
        else:
            lost = sum(m.kinds[i] == 2 for i in ids)
        total = sum(m.scores[i] for i in ids if m.kinds[i] == 1) + lost * unknown
        assert total == pytest.approx(best_score(m, shown))


@pytest.fixture(scope="module")
def real():
    if not Path(sentencepiece.MODEL).exists():
        pytest.skip("no model file")
    return sentencepiece.Model.load(sentencepiece.MODEL)


def test_real_vocabulary_round_trip(real):
    texts = ["", "a", " a  b ", "日本語😀 ß\n\n\t x", "   ", "x" * 300 + "é" * 200, "\x00 q", "word, word " * 50, "1234567890" * 20]
    ids = list(sentencepiece.encode_texts(real, texts))
    assert list(sentencepiece.decode_ids(real, ids)) == texts
    assert [len(i) for i in ids][0] == 0
    with pytest.raises(ValueError, match="outside"):
        list(sentencepiece.decode_ids(real, [np.array([10**6])]))


def test_real_vocabulary_against_the_library(real, spark):
    library = pytest.importorskip("sentencepiece")
    # the same file read as a unigram model: its lattice search maximises the same sum
    other = library.SentencePieceProcessor(model_proto=Path(sentencepiece.MODEL).read_bytes() + b"\x12\x02\x18\x01")
    texts = [r.text for r in spark.read.parquet(f"{PATH}/documents.parquet").limit(30).collect()]
    words = sorted({w for t in texts for w in t.split()})[:1500]
    score = lambda ids: sum(real.scores[i] for i in ids)
    known = equal = 0
    for word, ids in zip(words, sentencepiece.encode_texts(real, words), strict=True):
        theirs = other.nbest_encode_as_ids(word, 1)[0]
        if all(real.kinds[i] == 1 for i in [*ids, *theirs]):
            known += 1
            equal += score(ids) == score(theirs)
            assert score(ids) >= score(theirs)
            assert score(ids) == best_score(real, "▁" + word)
    assert known > 1000 and equal / known > 0.95


def test_tokens_of_odd_rows(spark, real):
    df = spark.createDataFrame([(1, None, 5), (1, "", 6), (None, "abc", 7), (2, "a b " * 30_000, 8), (3, "z" * 60_000, 9)], "doc_id long, text string, N_TOKENS int")
    rows = sentencepiece.encode(df).collect()
    assert [r.n_tokens for r in rows][:2] == [0, 0] and all(r.n_tokens == len(r.token_ids) for r in rows)
    back = sentencepiece.decode(sentencepiece.encode(df)).collect()
    assert [r.decoded for r in back] == ["", "", *[r.text for r in rows[2:]]]
    assert all(r.round_trip for r in sentencepiece.round_trip(df).collect())
    assert sentencepiece.encode(df.limit(0)).collect() == []


ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><p>Site name, slogan, and many other words that are long enough to count as text.</p></header>
<nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav>
<div id=wrap><div class="post-content"><h1>Head &amp; title</h1><p>First, the opening words of
the   article, which are long enough.<ul><li>point one<li>point <b>two</b></ul>
<p>Second part, with a <a href="/x">link</a>, and a break<br>after it; if (a < b) then &lt;c&gt; &eacute;.</p>
<script>document.write("<p>no</p>")</script><!-- <p>no</p> -->
<div class="share-buttons"><a href="#">Tweet</a></div><ul><li><a href="/1">More one</a></li><li><a href="/2">More two</a></li></ul></div>
<aside><p>Buy this now, it is very cheap, and the best there is, says everyone, everywhere.</p></aside>
<div class="cookie-notice"><p>We use cookies, many cookies, and you have to accept them, all of them.</p></div>
<div id="comments"><p>I do not agree, with any of this, at all, and I say so, at length, in this place.</p></div></div>
<form><p>Name, mail, and all the other fields that one has to fill in before sending.</p></form>
<footer>&copy; all, rights, reserved</footer></body></html>"""


def test_article_is_found():
    assert pages.main_text(ARTICLE) == "\n".join([
        "Head & title", "First, the opening words of the article, which are long enough.", "point one", "point two",
        "Second part, with a link, and a break after it; if (a < b) then <c> é.",
    ])


def test_sections_and_siblings():
    part = "<section><p>Some sentence, of a good length, number %d, is here.</p><p>And another, shorter one, %d.</p></section>"
    page = "<body><div>" + "".join(part % (k, k) for k in range(4)) + "</div><div class=x><a href=1>one</a> <a href=2>two</a></div>"
    assert pages.main_text(page).count("\n") == 7 and "two" not in pages.main_text(page)


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("   ", ""), ("plain words only", "plain words only"), ("<p>open", "open"), ("<p>a</b></div>b</p>c", "ab\nc"),
    ("<script>x", ""), ("<!-- x", ""), ("<a href='x>y'>l</a> t", "l t"), ("1 < 2 & 3 &amp 4 &nosuch; &#233;", "1 < 2 & 3 & 4 &nosuch; é"),
    ("<div hidden>no</div><p>yes, this one</p>", "yes, this one"), ("<b>one<br>two</b>", "one two"), ("<p>x  y\t\n z</p>", "x y z"),
    ("<div>" * 20_000 + "deep", "deep"), ("<b>" * 20_000 + "deep" + "</b>" * 20_000, "deep"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
])
def test_broken_pages(page, text):
    assert pages.main_text(page) == text


BODY = "<p>First, the opening words of the article, which are long enough.</p><p>Then, more of it, and an end.</p>"
BODY_TEXT = "First, the opening words of the article, which are long enough.\nThen, more of it, and an end."


@pytest.mark.parametrize(("page", "text"), [
    ("<article><svg class=icon />" + BODY + "</article><svg><text>no</text></svg>", BODY_TEXT),
    ("<article><svg/>" + BODY + "</article>", BODY_TEXT), ("<article><math/>" + BODY + "</article>", BODY_TEXT),
    ("<article><svg>" + BODY + "</article>", BODY_TEXT), ("<article><svg><text>no</text></svg>" + BODY + "</article>", BODY_TEXT),
    ("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation encoding=tex>x=1</annotation></math> holds</p>", "so x=1 holds"),
])
def test_foreign_elements_lose_no_article(page, text):
    assert pages.main_text(page) == text


@pytest.mark.parametrize("around", ["<div class='layout-sidebar-right'>%s</div>", "<form action=x>%s</form>", "<form><div class=with-sidebar>%s</div></form>"])
def test_wrappers_around_the_article_are_opened(around):
    menu, comment = "<nav><a href=1>One page of this site, and more</a></nav>", "<div id=comments><p>Not so, I say, at length, in this place.</p></div>"
    assert pages.main_text(menu + around % (BODY + menu + comment)) == BODY_TEXT
    assert pages.main_text(around % (BODY + comment) + "<p>Contact</p>") == BODY_TEXT
    assert pages.main_text("<div hidden>" + around % BODY + "</div><p>Contact</p>") == "Contact"
    assert pages.main_text("<div class=menu><a href=1>One page of this site, and more</a></div><p>Contact</p>") == "Contact"
    assert pages.main_text(BODY + around % (comment * 9)) == BODY_TEXT


def test_pages_of_the_table(spark):
    import re
    from html import unescape

    rows = {r.page_id: r for r in queries.REGISTRY["op3_page_text"](spark, PATH).collect()}
    table = spark.read.parquet(f"{PATH}/pages.parquet").collect()
    assert len(rows) == len(table)
    for r in table:
        inner = re.search("(?s)<article>(.*)</article>", r.html)[1]
        parts = (" ".join(unescape(re.sub("</?b>|<br>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", inner))
        text = "\n".join(x for x in parts if x)
        assert (rows[r.page_id].text, rows[r.page_id].n_chars) == (text, len(text))
    odd = spark.createDataFrame([(1, None, None), (1, "u", "<p>x"), (None, "u", "")], "page_id long, url string, html string")
    assert sorted(r.text for r in pages.extract(odd).collect()) == ["", "", "x"]


def test_mixture_meets_its_targets(spark, docs):
    rows = [(k, "x" * 100, None, "big" if k % 10 else "small", 100) for k in range(6000)] + [(9000 + k, "y" * 100, None, None, 100) for k in range(600)]
    out = mixing.mix(docs(rows), "s", {"big": 1.0, "small": 1.0})
    shares = {r.source: r.n for r in out.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert set(shares) == {"big", "small"} and all(abs(n - 3300) < 250 for n in shares.values())
    counts = [r.n for r in out.where("source = 'small'").groupBy("doc_id").agg(F.count("*").alias("n")).collect()]
    assert abs(np.var([*counts, *[0] * (600 - len(counts))]) - 5.5) < 1.5  # a Poisson variance is its mean
    again = mixing.mix(docs(rows).repartition(7), "s", {"big": 1.0, "small": 1.0})
    assert [tuple(r) for r in again.collect()] == [tuple(r) for r in out.collect()]
    keys = [r.shuffle_key for r in out.collect()]
    assert keys == sorted(keys)
    assert mixing.mix(docs(rows), "other", {"big": 1.0}).where("source = 'small'").count() == 0


def test_large_rates_and_odd_rows(spark, docs):
    rows = [(1, "a", None, "tiny", 1), (2, "b" * 1_000_000, None, "huge", 1), (3, None, None, "empty", 0), (None, "c", None, None, 1), (1, "a", None, "tiny", 1)]
    table = {r.source: r for r in mixing.rates(docs(rows)).collect()}
    assert table["empty"].rate == 1.0 and table["tiny"].rate > 100 and table["tiny"].parts == -(-table["tiny"].rate // 16)
    assert table["tiny"].cdf[-1] == pytest.approx(1)
    wide = docs(rows).withColumns({"Copy": F.lit(9), "_source": F.lit("x"), "_parts": F.lit(0), "_row": F.lit(1), "mass": F.lit(2)})
    assert mixing.mix(wide, "s").columns == [*corpus_pipeline.COLUMNS, "_source", "_parts", "_row", "mass", "copy", "shuffle_key"]
    got = mixing.mix(wide, "s").groupBy("source").count().collect()
    assert abs({r.source: r["count"] for r in got}["tiny"] - 2 * table["tiny"].rate) < 6 * (2 * table["tiny"].rate) ** 0.5 * 2
    assert mixing.mix(docs([]), "s").collect() == []


def test_pipeline_stage_by_stage(spark):
    """Every stage against a plain version on its own input."""
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, session.materialise(stage(spark, docs, PATH))
        seen[name] = (before, docs)
    as_rows = lambda df: [tuple(r) for r in df.select(corpus_pipeline.COLUMNS).collect()]
    before, after = seen[names[0]]
    good = {r.doc_id for r in quality.score(before, spark.read.parquet(f"{PATH}/labels.parquet")).where("predicted = 1").collect()}
    assert sorted(as_rows(after)) == sorted(r for r in as_rows(before) if r[0] in good)
    before, after = seen[names[1]]
    groups = near_groups([(r[0], r[1]) for r in as_rows(before)], 5, 80)
    assert sorted(as_rows(after)) == sorted(r for r in as_rows(before) if groups[r[0]][1] == r[0])
    before, after = seen[names[2]]
    kept = without_repeats([(r[0], r[1]) for r in as_rows(before)], 20)
    want = []
    for r in as_rows(before):
        total, removed, text = kept[r[0]]
        if not removed:
            want.append(r)
        elif removed < total:
            want.append((r[0], text, r[2], r[3], len(text)))
    assert sorted(as_rows(after)) == sorted(want)
    before, after = seen[names[3]]
    draws = mixing.mix(before, mixing.SEED).groupBy("doc_id").agg(F.max("copy").alias("n")).collect()
    assert sorted(as_rows(after)) == sorted(r for d in draws for r in as_rows(before) if r[0] == d.doc_id for _ in range(d.n))
    before, after = seen[names[4]]
    back = sentencepiece.decode(after).collect()
    assert len(back) == before.count() and all(r.decoded == r.text for r in back)


def test_near_dedup_keeps_other_texts_of_a_repeated_id(spark, docs):
    one, two, three = (" ".join(f"{c}{k}" for k in range(50)) for c in "xyz")
    rows = [(1, one), (2, one), (2, two), (3, three), (3, two), (4, one + " end"), (5, None), (5, ""), (None, one)]
    rows = [(i, t, "en", "s", 1) for i, t in rows]
    out = corpus_pipeline.one_of_each(spark, docs([*rows, rows[0]]), PATH)
    assert sorted(((r.doc_id or 0, r.text or "") for r in out.collect())) == [(0, one), (1, one), (2, two), (3, three), (5, ""), (5, "")]


def test_pipeline_on_empty_and_odd_tables(spark, tmp_path):
    long = " ".join(f"w{k}" for k in range(50))
    rows = [(None, long, "en", None, 1), (1, None, None, "s", 0), (1, None, None, "s", 0), (2, "", "en", "s", 0), (3, long, "en", "s", 5), (4, long, "en", "s", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for k, data in enumerate((rows, [])):
        folder = f"{tmp_path}/{k}"
        spark.createDataFrame(data, schema).withColumn("component_id", F.lit(1)).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        out = corpus_pipeline.run(spark, folder)
        assert out.columns == [*corpus_pipeline.COLUMNS, "n_tokens", "token_ids"]
        assert out.count() >= 0 and not out.where("doc_id = 4").count()


PARAGRAPHS = "".join(f"<p>This is paragraph {i} of the article, which has enough words, and commas, to count as text.</p>" for i in range(6))
OTHER = "<p>Unwanted words of somebody else, which are long enough, and so could be taken for text.</p>"


@pytest.mark.parametrize(
    "name",
    "post-comments article-comments article-footer content-sidebar main-nav post-tags page-footer page-ads content-ad main-cookie-banner "
    "article-newsletter story-share entry-related responses discussion user-opinions".split(),
)
@pytest.mark.parametrize("around", ["article", 'div class="post"', "div", 'section id="story"'])
def test_parts_named_as_something_else_go(name, around):
    page = f'<html><body><{around}>{PARAGRAPHS}<div class="{name}">{OTHER}</div></{around.split()[0]}></body></html>'
    assert pages.main_text(page).count("paragraph") == 6 and "Unwanted" not in pages.main_text(page)


@pytest.mark.parametrize("start", ['article class="comment"', 'article id="comment-12" class="odd"', 'article class="teaser"', 'article role="comment"'])
def test_articles_that_are_comments_or_teasers_go(start):
    inner = f"<{start}>{OTHER}</article>"
    for page in (
        f"<body><article>{PARAGRAPHS}{inner}</article></body>", f"<body><article>{PARAGRAPHS}</article>{inner}</body>",
        f"<body><main><article class='post tag-social category-promo'>{PARAGRAPHS}</article>{inner}</main></body>",
    ):
        assert pages.main_text(page).count("paragraph") == 6 and "Unwanted" not in pages.main_text(page)


@pytest.mark.parametrize("name", ["entry-header", "has-sidebar main", "post with-comments", "tag-newsletter post", "article-body", "page no-footer"])
def test_names_that_only_mention_other_parts_stay(name):
    assert pages.main_text(f'<body><div class="{name}">{PARAGRAPHS}</div></body>').count("paragraph") == 6
