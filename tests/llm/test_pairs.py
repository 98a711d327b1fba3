"""Near-duplicates, repeated windows, components and fingerprints against brute force on small fixtures."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from plain import near_groups, sha, union_find, without_repeats
from pyspark.sql import functions as F

from medley.llm import embeddings, minhash, spotsigs, substring, words
from medley.llm.components import components


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(300)] + ["the", "of", "Ä", "ß.", "x y"]
    passage = [rng.choice(vocab) for _ in range(60)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.3:
            w = (rng.choice(rows)[1] or "").split(" ")
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
        else:
            w = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 25, 80, 200]))]
            if kind > 0.7:
                w = w + passage[rng.randrange(30) :] + w[:5]
        rows.append((i * 3 + 1, rng.choice([" ", "  ", "\n"]).join(w)))
    return [*rows, (500, ""), (501, None), (502, " \n\t "), (503, "one"), (504, "ONE"), (505, "a " * 100), (506, "a " * 60)]


def test_words_are_hashed_as_they_are():
    import pyarrow as pa

    texts = ["a bb  a", None, "", "bb\x0ba\x1fz", "é" * 3000 + " bb", "a"]
    data, offsets = words.buffers(pa.array(texts))
    row, start, end = words.spans(data, offsets)
    got = [(int(r), bytes(data[s:e]).decode()) for r, s, e in zip(row, start, end, strict=True)]
    want = [(k, w) for k, t in enumerate(texts) for w in (t or "").encode().split()]
    assert got == [(k, w.decode()) for k, w in want]
    for limit in (1, 5, 1 << 20):  # pieces of any size give the same hashes
        hashed = words.hashes(data, start, end, limit)
        assert len(set(hashed.tolist())) == len({w for _, w in got})
        assert all(a == b for (_, x), a in zip(got, hashed, strict=True) for (_, y), b in zip(got, hashed, strict=True) if x == y)


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_minhash_links_what_all_pairs_do(spark, docs, size, percent):
    rows = corpus(1)
    got = {r.doc_id: r for r in minhash.near_duplicates(docs(rows), size, percent).collect()}
    want = near_groups(rows, size, percent)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


@pytest.mark.parametrize("percent", [80, 50])
def test_minhash_misses_few_pairs_at_any_threshold(spark, docs, percent):
    rows = []
    for k in range(80):  # pairs just at the threshold
        own = [f"p{k}w{i}" for i in range(percent)]
        rows += [(2 * k, " ".join([*own, *(f"p{k}a{i}" for i in range((100 - percent) // 2))])), (2 * k + 1, " ".join([*own, *(f"p{k}b{i}" for i in range((100 - percent) // 2))]))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs(rows), 1, percent).collect()}
    assert got == near_groups(rows, 1, percent) and all(got[2 * k + 1][1] == 2 * k for k in range(80))


def test_minhash_miss_rate():
    from math import comb

    c = minhash.COORDINATES
    for percent in range(43, 101):
        p = percent / 100
        assert sum(comb(c, k) * p**k * (1 - p) ** (c - k) for k in range(minhash.matches(percent))) <= minhash.MISS
    assert (minhash.matches(85), minhash.matches(80), minhash.matches(100)) == (11, 9, c)
    for percent in (0, 42, 101):
        with pytest.raises(ValueError, match="percent"):
            minhash.matches(percent)


def test_minhash_blocks_of_a_large_group(spark, docs, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 7)
    rng = random.Random(4)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(40):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(60)] = f"x{rng.randrange(50)}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs(rows), 3, 85).collect()}
    assert got == near_groups(rows, 3, 85)


def test_minhash_null_ids_and_empty_table(spark, docs):
    long = " ".join(f"q{k}" for k in range(40))
    rows = minhash.near_duplicates(docs([(None, long), (1, long), (2, long)])).collect()
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in rows) == [(0, None, True), (1, 1, True), (2, 1, False)]
    assert minhash.near_duplicates(docs([])).collect() == []
    twice = minhash.near_duplicates(docs([(1, long), (1, long)])).collect()
    assert [(r.doc_id, r.component_id, r.kept) for r in twice] == [(1, 1, True)] * 2


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (3, 3), (200, 201), (201, 200)]
    rng.shuffle(links)
    df = spark.createDataFrame([*links, (None, 5), (5, None)], "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == union_find({n for a, b in links if a != b for n in (a, b)}, links)
    assert components(df.limit(0)).collect() == []


@pytest.mark.parametrize("bucket", [20_000, 2])
def test_repeated_windows(spark, docs, monkeypatch, bucket):
    monkeypatch.setattr(substring, "BUCKET", bucket)  # 2 splits almost every bucket into parts
    rows = corpus(3) + [(600, " ".join(f"p{k}" for k in range(25)) * 3)]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring.remove_repeats(docs(rows)).collect()}
    assert got == without_repeats(rows, substring.WINDOW)


def test_repeated_windows_null_ids_repeated_rows_and_clashing_columns(spark):
    long = " ".join(f"q{k}" for k in range(30))
    rows = [(None, long, 1), (4, long, 2), (4, long, 2), (5, long + " z", 3), (6, None, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words long").withColumns({c: F.lit(7) for c in ("_row", "whole", "runs", "_id", "hits")})
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed, sha(r.kept_text)) for r in substring.remove_repeats(df).collect())
    assert got == sorted([(0, 30, 0, sha(long)), (4, 30, 0, sha(long)), (4, 30, 0, sha(long)), (5, 31, 30, sha("z")), (6, 0, 0, sha(""))])
    assert substring.remove_repeats(df.limit(0)).collect() == []


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def test_embeddings_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 48))
    rows, kept = [], {}
    for i in range(150):
        v = centres[i % 12] + rng.normal(size=48) * rng.choice([0.0, 0.1, 0.25, 0.5])
        rows.append((i, (v * rng.choice([1e-3, 1.0, 1e6])).tolist(), int(i % 12 % 2)))
        kept[i] = (v / np.linalg.norm(v), i % 12 % 2)
    odd = [(200, None, 1), (201, [0.0] * 48, 1), (202, [float("nan")] * 48, 1), (203, [None] * 48, 1), (204, centres[0].tolist(), None)]
    odd += [(205, [1.0, 2.0], 0), (206, [2.0, 4.0], 0), (207, [], 0), (None, centres[0].tolist(), 0), (208, [float("inf")] * 48, 0)]
    got = {r.vec_id: r for r in embeddings.near_duplicates(vectors(spark, [*rows, *odd]), 0.93).collect()}
    links = [(a, b) for a in kept for b in kept if a < b and kept[a][1] == kept[b][1] and kept[a][0] @ kept[b][0] >= 0.93] + [(205, 206)]
    parts = union_find(set(got) - {None}, links)
    assert len(links) > 150
    for i, part in parts.items():
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (sum(i in p for p in links), part, part == i)
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, True)
    assert embeddings.near_duplicates(vectors(spark, []), 0.93).collect() == []


def test_rotation_codes_estimate_without_bias():
    rng = np.random.default_rng(1)
    x = embeddings.unit(rng.normal(size=(3000, 64)))
    y = embeddings.unit(0.7 * x + 0.3 * rng.normal(size=x.shape) / 8)
    code, factor = embeddings.encode(x)
    signs = np.unpackbits(code, 1, 64).astype(float) * 2 - 1
    estimate = (signs * (y @ embeddings.rotation(64))).sum(1) / (8 * factor)
    error = estimate - (x * y).sum(1)
    assert abs(error.mean()) < 0.01
    far = embeddings.candidates(code[:500], factor[:500], x[:500], 0.93, embeddings.SPREADS)
    assert far.diagonal().all() and far.mean() < 0.05


def test_spot_signatures(spark, docs):
    rows = corpus(6) + [(700, None)]
    got = {r.doc_id: r for r in spotsigs.compare_edits(docs(rows)).collect()}
    order = sorted((i, t or "") for i, t in rows)
    for k, (i, text) in enumerate(order):
        after, cut = order[(k + 1) % len(order)][1], len(text) // 4
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), sha(text[: len(text) - cut] + after[:cut]))
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        assert got[i].fingerprint == ",".join(plain_signatures(text))
    one, two = ({x for x in got[i].fingerprint.split(",") if x} for i in (order[0][0], order[1][0]))
    assert got[order[0][0]].near_next == pytest.approx(len(one & two) / max(1, len(one | two)))
    texts = {i: t or "" for i, t in rows}
    for a in got:
        for b in got:
            if texts[a] == texts[b]:
                assert got[a].fingerprint == got[b].fingerprint
    assert spotsigs.compare_edits(docs([])).collect() == []


def test_spot_chains_skip_stop_words_and_gaps_are_filled(spark):
    text = "The very big house of the old man is by the sea and the dog was a good dog one two three four five six seven"
    df = spark.createDataFrame([(text,)], "text string")
    got = df.select(spotsigs.signatures(df.text).alias("s")).first().s
    chains = [("the", "very big"), ("of", "old man"), ("the", "old man"), ("is", "sea dog"), ("the", "sea dog"), ("the", "dog good"), ("was", "good dog"),
              ("a", "good dog"), ("five", "six seven"), ("six", "seven"), ("seven", "")]
    # the last anchor covers six words, and from the fourth number on every word stands for itself
    chains.insert(8, ("four", "five six"))
    assert set(got) <= {hashlib.md5(f"{a}|{c}".encode()).hexdigest()[:12] for a, c in chains} and len(got) >= 10
    assert got == plain_signatures(text)


def plain_signatures(text):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    seen, out = Counter(), []
    for i, x in enumerate(w):
        if x in spotsigs.ANCHORS:
            chain = [y for y in w[i + 1 : i + 1 + spotsigs.SPAN] if y not in spotsigs.ANCHORS and y not in spotsigs.STOP][: spotsigs.CHAIN]
        elif not set(w[max(0, i - spotsigs.SPAN + 1) : i + 1]) & set(spotsigs.ANCHORS):
            chain = w[i + 1 : i + 1 + spotsigs.CHAIN]
        else:
            continue
        mark = hashlib.md5(f"{x}|{' '.join(chain)}".encode()).hexdigest()[:12]
        out.append((mark, seen[mark]))
        seen[mark] += 1
    return [f"{m}+{n}" if n else m for m, n in sorted(out)]


def test_signatures_of_odd_texts(spark):
    texts = ["", None, "the", "der der der der", "x", "it it it", "word " * 3000, "the " * 3000 + "end", "!!! ...", "a b c d e f g h i j k l m n " * 30]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    for r in rows.select("i", spotsigs.signatures(F.col("text")).alias("s")).collect():
        assert r.s == plain_signatures(texts[r.i])


def test_edits_keep_likeness_and_unlike_texts_differ(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = spotsigs.compare_edits(docs).join(docs.select("doc_id", "text"), "doc_id").collect()
    assert min(r.near_edited for r in rows if len(r.text.split()) >= 64) >= 0.3
    found = {}
    for r in rows:
        w = [x for x in re.split(r"[\W_]+", r.text.lower()) if x]
        found.setdefault(r.fingerprint, []).append({tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))})
    assert all(len(a & same[0]) >= 0.5 * len(a | same[0]) for same in found.values() for a in same)


def test_spot_near_pairs(spark, docs):
    rows = corpus(8)
    member, pairs = spotsigs.near_pairs(docs(rows), 0.6)
    sets = {r.doc_id: set(r.s) for r in docs(rows).select("doc_id", spotsigs.signatures(F.col("text")).alias("s")).collect()}
    reps = {r.doc_id: r.rep for r in member.collect()}
    for a in sets:
        same = [b for b in sets if sets[a] and sets[b] == sets[a]]
        assert reps[a] == min(same, default=a)
    want = {
        frozenset((a, b)) for a in sets for b in sets
        if a < b and reps[a] == a and reps[b] == b and sets[a] and sets[b] and sets[a] != sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.6
    }
    assert {frozenset((r.a, r.b)) for r in pairs.collect()} == want and want


def test_null_id_and_repeated_ids_in_fingerprints(spark, docs):
    rows = spotsigs.compare_edits(docs([(None, "abcd efgh"), (7, "same text here"), (7, "same text here")])).collect()
    assert len(rows) == 3 and [r.near_next for r in rows if r.doc_id == 7] == [1.0, 1.0]
    assert [r.edited_sha256 for r in rows if r.doc_id is None] == [sha("abcd ef")]
