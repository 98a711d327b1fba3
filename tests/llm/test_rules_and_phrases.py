"""Fill-in-middle, line rules and collocations against plain versions on small tables."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import numpy as np
import pyarrow as pa
import pytest
from plain import sha
from pyspark.sql import functions as F

from medley.llm import collocations, infill, queries, rules

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = ["", " ", "\n \t", "\x0b", "a", " a", "a ", "ü ", " ", "a b", "é" * 2000, "x " * 3000, " " * 1500 + "ß"]


def texts():
    r = random.Random(5)
    made = ["".join(r.choice(["w", "ü", "語", " ", "\n", "\t", "😀", "."]) for _ in range(r.randrange(1, 2500))) for _ in range(60)]
    return [*BLANKS, *made, "holds <P> a mark", "a<b <S", "S> <M", "<<S>"]


def plain_fim(doc_id, text, seed=42, rate=50, spm=80):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{doc_id if doc_id is not None else ''}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize(("rate", "spm"), [(50, 80), (100, 0), (100, 100)])
def test_infill_equals_the_plain_form_and_comes_back(spark, rate, spm):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "no id here"), (3, None), (3, "again under an id"), (3, "again under an id")]
    docs = spark.createDataFrame([(i, t, "x", 1.5) for i, t in rows], "doc_id long, text string, output string, Form double").repartition(3)
    got = infill.fill_in_middle(docs, rate=rate, spm=spm)
    assert sorted(got.columns) == sorted(["doc_id", "text", *infill.ADDED])
    out = got.withColumn("back", infill.restored()).collect()
    assert len(out) == len(rows) and {"psm", "spm"} & {r.form for r in out}
    for r in out:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_fim(r.doc_id, r.text, 42, rate, spm)
        assert r.back == (r.text or "")


def test_infill_empty_and_marks(spark, docs):
    assert infill.fill_in_middle(docs([]), 1).count() == 0
    for bad in (("<P>", "<P>", "<M>"), ("", "a", "b"), ("ab", "ba", "c"), ("aa", "b", "c"), ("abc", "b", "x")):
        with pytest.raises(ValueError):
            infill.check(bad)
    infill.check(("[[P]>", "<S>", "{M}"))


def test_fenwick_finds_every_rank():
    counts = np.array([[0, 3, 0, 0, 2, 1, 0, 7, 0], [5, 1, 1, 1, 9, 2, 0, 3, 3]])
    tree, owner = infill.Fenwick(counts), np.repeat(np.arange(9), counts[0])
    at, sums = tree.descend(np.arange(1, 14))
    assert (at == owner).all()
    for k in range(2):
        before = np.concatenate([[0], np.cumsum(counts[k])])
        assert (sums[k] == before[owner]).all() and (tree.before(np.arange(10))[k] == before).all()


def plain_rules(text):
    text = text or ""
    words = WORD.findall(text)
    again = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if again[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = text.split("\n")
    filled = [x for x in lines if WORD.search(x)]

    def stays(line):
        n = len(WORD.findall(line))
        ends = re.search(r"""[.!?…。！？]["'”’»)\]]*([\x20\x09-\x0D]|$)""", line)
        marks, bars = sum(c in rules.MARKS for c in line), sum(c in rules.BARS for c in line)
        notice = n <= rules.SHORT_LINE and re.search("(^|[^A-Za-z])(" + "|".join(map(re.escape, rules.PHRASES)) + ")", line, re.I | re.A)
        return not n or bool(ends and 2 * marks <= n and 5 * bars < n and not notice)

    lost = sum(len(WORD.findall(x)) for x in lines if not stays(x))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    counts = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(filled) - len(set(filled)), len(covered), lost)
    return (*counts, failed, not failed and 100 * lost <= rules.LOST * len(words), "\n".join(x for x in lines if stays(x)))


def line_texts():
    r = random.Random(9)
    vocabulary = ["alpha", "beta", "Gamma.", "delta", "|", "!!", "größe", "a", "b", "c", "d!", "$$$", "*", "fin.”"]
    made = ["\n".join(" ".join(r.choices(vocabulary, k=r.randrange(0, 30))) for _ in range(r.randrange(1, 8))) for _ in range(120)]
    good = "\n".join(f"This is clean sentence number {i}, which says something of its own {i * i}." for i in range(12))
    bad = ["All Rights Reserved. " + good, good + "\nPlease accept cookies and sign up.", good + "\nhome | news | about | log in |", good.replace(".", ""), (good + "\n") * 3]
    return [good, *bad, *made, *BLANKS, "w " * 49, "w " * 50, "a b c a b c " * 20, " \r\n \n", good.replace("\n", "\r\n")]


def test_rules_equal_the_plain_form(spark):
    rows = [(i, t) for i, t in enumerate(line_texts())] + [(None, None), (1, "same id")]
    docs = spark.createDataFrame([(i, t, True, "c") for i, t in rows], "doc_id long, text string, kept boolean, Cleaned string")
    got = rules.clean(docs)
    assert sorted(got.columns) == sorted(["doc_id", "text", *rules.ADDED])
    for r in got.collect():
        assert tuple(r[c] for c in rules.ADDED) == plain_rules(r.text), r.text
    assert rules.clean(docs.limit(0)).count() == 0


def test_rules_hold_no_python(spark):
    plan = rules.clean(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


PIECE = re.compile(r"[.,;:!?\x0A-\x0D]")


def plain_collocations(rows, least, top, inside=50):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in PIECE.split(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    found = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= least:
            cuts = [(10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found[lang, p] = (a, f[lang, p[:k]], f[lang, p[k:]], score)
    gone = {(lang, p[i : i + 2]) for (lang, p), v in found.items() if len(p) == 3 for i in (0, 1) if 100 * v[0] >= inside * f[lang, p[i : i + 2]]}
    out = []
    for lang in n:
        own = sorted(((-v[3], -v[0], " ".join(p).encode(), v) for (x, p), v in found.items() if x == lang and (lang, p) not in gone))
        out += [(lang, i + 1, p.decode(), *v[:3], n[lang], v[3]) for i, (_, _, p, v) in enumerate(own[:top])]
    return out


@pytest.fixture(scope="module")
def phrases():
    r = random.Random(3)
    vocabulary = ["New", "york", "city", "the", "of", "größe", "語", "a-b", "x y", " "]
    made = [("".join(r.choice(vocabulary) + r.choice([" ", " ", " ", "\t ", ", ", ".\n", ""]) for _ in range(r.randrange(0, 80))), r.choice(["en", "de", None, ""])) for _ in range(90)]
    return [*made, (None, "en"), ("", None), ("new york city hall " * 40, "en"), ("word" * 30000, "de"), ("new york " * 9000, "fr")]


@pytest.mark.parametrize("bits", [64, 14, 4])
def test_collocations_equal_counting_by_text(spark, phrases, same, bits):
    rows = [(i if i % 5 else None, t, lang, 1) for i, (t, lang) in enumerate(phrases)] + [(1, phrases[0][0], "en", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, rank int").repartition(3)
    want = plain_collocations([(t, lang) for _, t, lang, _ in rows], 4, 15)
    assert len(want) > 40
    same(collocations.collocations(docs, 4, 15, bits=bits).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), want)


def test_collocations_of_nothing(spark, docs):
    assert collocations.collocations(docs([])).count() == 0
    assert collocations.collocations(docs([(1, "one two", "en")])).count() == 0


def test_fingerprints_of_runs_equal_those_of_phrases():
    text = "Ab cd. ef\tgh  ij, kl\nmn op qr"
    at = collocations.Words(*collocations.words.buffers(pa.array([text, "", "zz yy xx"])))
    salts = np.array([collocations.lang_salt("en")] * 3, np.uint64)
    want = {2: ["ab cd", "ef gh", "gh ij", "mn op", "op qr", "zz yy", "yy xx"], 3: ["ef gh ij", "mn op qr", "zz yy xx"]}
    for k, phrases in want.items():
        got = [collocations.sized(v, k, (1 << 64) - 1)[at.phrases(k)] for v in at.hashed(0, len(at.start), [k], collocations.BASES[0], salts)][0]
        assert got.tolist() == collocations.fingerprints([p.encode() for p in phrases], ["en"] * len(phrases), (1 << 64) - 1)[0].tolist()


def test_the_bitmap_holds_what_was_put_in(spark):
    values = [-1, 0, 1, 1 << 62, -(1 << 63), 123456789123456789]
    bits = np.frombuffer(collocations.bitmap_of(spark.createDataFrame([(v,) for v in values], "fp long")), np.uint8)
    assert collocations.known(bits, np.array(values, np.int64).view(np.uint64)).all() and int(np.unpackbits(bits).sum()) == 5


def test_queries_derive_their_columns(spark, tmp_path):
    rows = [(1, "one two  three. " * 30, "en", "s", 1), (2, None, None, "s", 0), (3, "", "de", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    eleven = {r.doc_id: r for r in queries.op11(spark, str(tmp_path)).collect()}
    assert all(eleven[i].restored_sha256 == sha(t or "") for i, t, *_ in rows) and eleven[1].n == 91
    twelve = {r.doc_id: r for r in queries.op12(spark, str(tmp_path)).collect()}
    assert (twelve[1].n_words, twelve[1].base_failed, twelve[2].n_words, twelve[2].kept) == (90, True, 0, False)
    assert queries.op13(spark, str(tmp_path)).filter(F.col("phrase") == "one two three").first().a == 30


def test_fingerprints_travel_packed_and_are_summed_by_bucket(docs):
    rng = np.random.default_rng(4)
    fp = rng.integers(-(2**63), 2**63 - 1, 300)[rng.integers(0, 300, 5000)]
    n, checks, key = rng.integers(1, 9, 5000), rng.integers(0, 1 << 20, 5000), rng.integers(-(2**63), 2**63 - 1, 5000)
    want: dict[int, tuple[int, int, int]] = {}
    for f, a, b, c in zip(fp.tolist(), n.tolist(), checks.tolist(), key.tolist(), strict=True):
        x = want.get(f, (0, 0, c))
        want[f] = (x[0] + a, x[1] + b, min(x[2], c))
    pieces = [collocations.packed(collocations.grouped(*(c[low : low + 700] for c in (fp, n, checks, key)))) for low in range(0, 5000, 700)]
    assert all(len(set(p.column("bucket").to_pylist())) == p.num_rows for p in pieces)
    table = pa.Table.from_batches([p.slice(k, 9) for p in pieces for k in range(0, p.num_rows, 9)])
    got = collocations.grouped(*(collocations.unpacked(table.column(c)) for c in range(1, 5)))
    assert {f: tuple(x) for f, *x in zip(*(c.tolist() for c in got), strict=True)} == want
    counted = collocations.count_phrases(docs([(i, "a b c. a b", "en") for i in range(6)]).withColumnRenamed("doc_id", "key"), [0, 1, 2], -4 & (1 << 64) - 1, least=12)
    assert "Aggregate" not in counted._jdf.queryExecution().executedPlan().toString()  # no row of its own for each fingerprint
    assert sorted(r.n for r in counted.collect()) == [12, 12, 12, 30]
