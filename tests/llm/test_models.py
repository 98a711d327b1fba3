"""The trained models: their arithmetic against plain loops, and held-out accuracy on the given tables."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from medley.llm import base, language, quality, queries, toxicity, words

PATH = "/root/testdata/sf0.01"


def column(texts):
    return words.buffers(pa.array(texts, pa.string()))


def test_quality_network_is_a_plain_convolution():
    rng = np.random.default_rng(0)
    net = quality.learn(["ab " * 30, "X!! " * 400], [1, 0], epochs=1, steps=1)
    net.bias[:] = rng.normal(size=quality.FILTERS) * 0.3
    texts = ["", None, "abc", "word " * 130, "".join(chr(97 + k) for k in rng.integers(0, 26, 3000)), "é" * 256]
    got = quality.probability(net, *column(texts))
    for text, p in zip(texts, got, strict=True):
        raw = list((text or "").encode())
        raw += [quality.PAD] * (max(2 * quality.HOP, -(-len(raw) // quality.HOP) * quality.HOP) - len(raw))
        chunks = []
        for low in range(0, len(raw) - quality.HOP, quality.HOP):
            chunk = net.embed[raw[low : low + quality.CHUNK]]
            places = [chunk[k : k + 2 * quality.STRIDE].reshape(-1) @ net.conv for k in range(0, quality.CHUNK - quality.STRIDE, quality.STRIDE)]
            chunks.append(np.maximum(np.max(places, 0) + net.bias, 0))
        z = np.concatenate([np.max(chunks, 0), np.mean(chunks, 0)]) @ net.out + net.out_bias[0]
        assert p == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-5)


def test_quality_pieces_do_not_matter(monkeypatch):
    net = quality.learn(["ab " * 30, "X!! " * 400], [1, 0], epochs=1, steps=1)
    data, offsets = column(["some text " * 200, "b", "and more, " * 90])
    whole = quality.probability(net, data, offsets)
    monkeypatch.setattr(quality, "PIECE", 512)
    assert quality.probability(net, data, offsets) == pytest.approx(whole, abs=1e-6)


def test_quality_gradients():
    net = quality.learn(["ab " * 30, "X!! " * 400], [1, 0], epochs=1, steps=1)
    for k in ("embed", "conv", "bias", "out", "out_bias"):
        setattr(net, k, getattr(net, k).astype(np.float64))
    data, offsets = column(["one text here " * 60, "ANOTHER!! " * 20, "x"])
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        p = quality.probability(net, data, offsets)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    rng = np.random.default_rng(3)
    for weights, grad in zip(net.parts(), quality._gradients(net, data, offsets, y), strict=True):
        flat, seen = weights.reshape(-1), np.flatnonzero(np.abs(grad.reshape(-1)) > 1e-4)
        for k in rng.choice(seen, min(5, len(seen)), replace=False):
            old, step = flat[k], 1e-5
            flat[k] = old + step
            up = loss()
            flat[k] = old - step
            down = loss()
            flat[k] = old
            assert grad.reshape(-1)[k] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=1e-4)


def test_toxicity_gradients():
    net = {k: v.astype(np.float64) for k, v in toxicity.new_net(1).items()}
    data, offsets = column(["you are kind, and so is the sea", "a b c " * 20, ""])
    data, row, start, end = toxicity.tokens(data, offsets)
    index, bucket, tri, size = toxicity.vocabulary(data, start, end)
    at, doc = toxicity.windows(row, 3)
    ids = np.where(at >= 0, index[at], -1)
    y = np.array([1.0, 0.0, 1.0])[doc]

    def odds():
        return toxicity.forward(net, toxicity.inputs(net, bucket, tri, size).astype(np.float64), ids)

    def loss():
        p = 1 / (1 + np.exp(-odds()))
        return -np.sum(y * np.log(p) + (1 - y) * np.log(1 - p))

    keep = {}
    x = toxicity.inputs(net, bucket, tri, size).astype(np.float64)
    g = 1 / (1 + np.exp(-toxicity.forward(net, x, ids, keep))) - y
    grads, d_x = toxicity.backward(net, x, ids, keep, g)
    grads |= toxicity._spread(net, bucket, tri, size, d_x)
    rng = np.random.default_rng(3)
    for name, grad in grads.items():
        flat, seen = net[name].reshape(-1), np.flatnonzero(np.abs(grad.reshape(-1)) > 1e-5)
        for k in rng.choice(seen, min(4, len(seen)), replace=False):
            old, step = flat[k], 1e-3
            flat[k] = old + step
            up = loss()
            flat[k] = old - step
            down = loss()
            flat[k] = old
            assert grad.reshape(-1)[k] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=2e-3), name


def test_toxicity_windows_cover_every_word():
    for n in (0, 1, 16, 32, 33, 48, 100):
        at, doc = toxicity.windows(np.zeros(n, np.int64), 1)
        assert set(at[at >= 0].tolist()) == set(range(n)) and len(at) == max(1, -(-(n - 16) // 16))
        assert (doc == 0).all()


def test_toxicity_score_does_not_depend_on_its_company():
    net = toxicity.new_net(2)
    texts = ["some words, here", "more of them " * 50, "", "zzz"]
    alone = [toxicity.probability(net, *column([t]))[0] for t in texts]
    assert toxicity.probability(net, *column(texts)) == pytest.approx(alone, abs=1e-6)


def test_rank_order_profiles_by_counting():
    from collections import Counter

    text = "Ab ab, ba! Éa ab"
    grams = Counter()
    for word in ("ab", "ab", "ba", "éa", "ab"):
        padded = f" {word} "
        grams.update(word)
        grams.update(padded[k : k + 2] for k in range(len(padded) - 1))
        grams.update(padded[k : k + 3] for k in range(len(padded) - 2))
    want = sorted(grams, key=lambda g: (-grams[g], len(g), g))
    code = [sum(ord(c) << (21 * k) for k, c in enumerate(reversed(g))) for g in want]
    _, gram, rank = language.top_grams(["", text, "12 34"], 300)
    assert gram.tolist() == code and rank.tolist() == list(range(len(code)))
    _, few, _ = language.top_grams([text], 4)
    assert few.tolist() == code[:4]


def test_out_of_place_distance(spark):
    model = language.learn(spark.createDataFrame([("aaa aab aab", "x"), ("zzz zzy zzy", "y")], "text string, label string"), 5)
    names, scores = model.predict(["aab", None, "", "123", "zzy zz"])
    assert names == ["x", "und", "und", "und", "y"]
    assert scores[1:4] == [0.0, 0.0, 0.0] and all(0.5 <= s <= 1 for s in (scores[0], scores[4]))


def plain_profile(texts, top):
    grams = Counter()
    for text in texts:
        for run in "".join(c if c.isalpha() else " " for c in text.lower()).split():
            grams.update(run)
            padded = f" {run} "
            grams.update(padded[k : k + n] for n in (2, 3) for k in range(len(padded) - n + 1))
    return {g: k for k, g in enumerate(sorted(grams, key=lambda g: (-grams[g], len(g), g))[:top])}


def test_predictions_equal_plain_distances(spark):
    labelled = [("the cat and the hat, ate that", "en"), ("der Hund und die Katze", "de"), ("und der große Baum", "de"), ("le chat et la ville", "fr"), ("x" * 30_000 + " tail end", "xx")]
    asked = ["the hat", "die Hunde", "la chatte et le", "xx tail", "größer", "qqq", "a", "e e", "the der le"]
    top = 12
    model = language.learn(spark.createDataFrame(labelled, "text string, label string").repartition(3), top)
    known = {name: plain_profile([t for t, x in labelled if x == name], top) for name in ("de", "en", "fr", "xx")}
    names, scores = model.predict(asked)
    for text, name, score in zip(asked, names, scores, strict=True):
        own = plain_profile([text], top)
        far = {x: sum(abs(p[g] - k) if g in p else top for g, k in own.items()) for x, p in known.items()}
        first, second = sorted(far.values())[:2]
        assert name == min(far, key=lambda x: (far[x], x)) and score == pytest.approx(second / (first + second))


@pytest.mark.parametrize(("name", "label", "least"), [("op6_quality_cnn", "quality", 0.93), ("op7_toxicity_gru", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    rows = queries.REGISTRY[name](spark, PATH)
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    assert rows.count() == docs.count()
    known = rows.join(spark.read.parquet(f"{PATH}/labels.parquet"), "doc_id").toPandas()
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(known.doc_id, known.held_out, strict=True))
    held = known[known.held_out]
    assert (held.predicted == held[label]).mean() >= least
    assert known.score.between(0, 1).all()


def test_language_held_out_accuracy(spark):
    rows = queries.REGISTRY["op8_language_id"](spark, PATH).join(spark.read.parquet(f"{PATH}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = rows.where("held_out").toPandas()
    assert (held.lang == held.lang_pred).mean() > 0.98


def odd_rows(spark):
    rows = [(None, "abc def", "en", 1), (1, None, "en", 2), (1, "", None, 3), (2, "x" * 100_000, "en", 4), (3, "né " * 40_000, "fr", 5), (3, "né", "fr", 6)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")


def test_models_on_odd_rows_and_without_labels(spark):
    docs = odd_rows(spark)
    labels = spark.createDataFrame([(2, 1, 0), (3, 0, 0), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    for model in (quality.score, toxicity.score):
        for known in (labels, labels.limit(0)):
            rows = model(docs, known).collect()
            assert len(rows) == 6 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
        assert model(docs.limit(0), labels).collect() == []
    assert {r.score for r in quality.score(docs, labels.limit(0)).collect()} == {0.5}
    assert len(language.identify(docs).collect()) == 6
    assert {(r.lang_pred, r.score) for r in language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {("und", 0.0)}
    assert language.identify(docs.limit(0)).collect() == []


def test_training_sample_leaves_held_out_rows(spark):
    docs = spark.createDataFrame([(k, f"text {k}", k % 2) for k in range(2000)] + [(None, "x", 1), (5000, None, 1)], "doc_id long, text string, label int")
    rows = base.training_sample(docs, docs, 200, "s").collect()
    assert not any(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    assert all(150 < sum(r.label == k for r in rows) < 260 for k in (0, 1))
    assert len(base.training_sample(docs, docs, 10_000, "s").collect()) == sum(zlib.crc32(str(k).encode()) % 4 != 2 for k in range(2000))


@pytest.mark.parametrize("model", [quality, toxicity])
def test_models_learn_from_whole_texts(spark, monkeypatch, model):
    texts = [f"{k} " + "plain words " * 2000 + "one bad passage" for k in range(8)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(8)], "doc_id long, quality int, toxic int")
    seen, learn = [], model.learn
    monkeypatch.setattr(model, "learn", lambda texts, labels: seen.extend(texts) or learn([], []))
    model.score(docs, labels)
    assert seen and set(seen) <= set(texts)


def test_excerpt_is_bounded(spark):
    df = spark.createDataFrame([("a" * 50,), ("".join(chr(97 + k % 26) for k in range(10_000)),)], "t string")
    short, long = (r.e for r in df.select(base.excerpt(F.col("t"), 800).alias("e")).collect())
    assert short == "a" * 50 and len(long) == 807
