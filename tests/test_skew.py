"""Operators on frames where one key holds a third of the rows, with the hot path forced."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from medley.operators import joins, quantiles, skew, windows


def skewed(n=3000, seed=7):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else (None if i % 3 == 1 and i % 2 else f"k{i % 41}")
        at = 5 if rng.random() < 0.3 else rng.choice([None, *range(200)])
        rows.append((key, at, i, rng.choice([None, rng.random()])))
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(skewed(), "k string, t long, i long, v double").cache()


def equal(a, b):
    b = b.select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("order", [["t", "i"], ["flag", "i"], ["pair"], ["z"]])
def test_parts_are_small_whatever_a_group_holds(frame, order):
    # texts that differ behind a long common prefix, booleans and structs
    wide = frame.withColumns({
        "z": F.concat(F.lit("document-0000000000000-"), F.lpad(F.col("i").cast("string"), 9, "0")),
        "flag": F.col("i") % 2 == 0,
        "pair": F.struct("t", "i"),
    })
    split = skew.split_groups(wide, ["k"], order, 20)
    sizes = [r["count"] for r in split.frame.groupBy(skew.PART).count().collect()]
    assert len(sizes) > 15 and max(sizes) <= 4 * 3000 / 20
    assert split.order == [*order, skew.TIE]


def test_a_thousand_large_groups(spark):
    df = spark.range(100_000).select((F.col("id") % 1000).alias("k"), F.col("id"))
    split = skew.split_groups(df, ["k"], ["id"], 50)
    assert split.frame.groupBy(skew.PART).count().agg(F.max("count")).first()[0] <= 4 * 2000
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("id")).cast("long"))
    equal(skew.running(df, ["k"], ["id"], {"n": ("count", "*")}, 50), want)


@pytest.mark.parametrize("parts", [None, 1, 50])
def test_running_equals_window(frame, parts):
    w = Window.partitionBy("k").orderBy("t", "i").rowsBetween(Window.unboundedPreceding, 0)
    want = frame.select(
        "*", F.max("v").over(w).alias("m"), F.last("v", True).over(w).alias("l"), F.count(F.lit(1)).over(w).alias("n"),
        F.count("v").over(w).alias("c"), F.sum("i").over(w).alias("s"),
    )
    outputs = {"m": ("max", "v"), "l": ("last", "v"), "n": ("count", "*"), "c": ("count", "v"), "s": ("sum", "i")}
    equal(skew.running(frame, ["k"], ["t", "i"], outputs, parts), want)


def test_copies_are_split_too(spark):
    rows = [("hot", 1, 1.0)] * 600 + [("hot", 0, 5.0), ("hot", 2, None), ("x", 1, 2.0)]
    df = spark.createDataFrame(rows, "k string, t int, v double").repartition(4)
    split = skew.split_groups(df, ["k"], ["t"], 10)
    assert split.frame.groupBy(skew.PART).count().agg(F.max("count")).first()[0] <= 4 * 60
    got = skew.running(df, ["k"], ["t"], {"n": ("count", "*"), "m": ("max", "v"), "p": ("previous", "t")}, 10)
    assert got.columns == ["k", "t", "v", "n", "m", "p"]
    hot = sorted((r["n"], r["t"], r["m"], r["p"]) for r in got.filter("k = 'hot'").collect())
    assert [h[0] for h in hot] == list(range(1, 603))
    assert [h[1] for h in hot] == [0] + [1] * 600 + [2] and {h[2] for h in hot} == {5.0}
    assert [h[3] for h in hot] == [None, 0] + [1] * 600


@pytest.mark.parametrize("parts", [None, 50])
def test_previous_equals_lag(frame, parts):
    want = frame.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("t", "i")))
    equal(skew.running(frame, ["k"], ["t", "i"], {"p": ("previous", "v")}, parts), want)


def test_asof_with_copies_on_both_sides(spark, same):
    left = [("a", 5, 1)] * 500 + [("a", 1, 2), ("a", 9, 3)]
    right = [("a", 5, 7, 0.5)] * 400 + [("a", 4, 1, 0.1), ("a", 6, 2, None)]
    a = spark.createDataFrame(left, "k string, t long, i long")
    b = spark.createDataFrame(right, "k string, t long, ri long, rv double")
    got = joins.asof(a, b, ["k"], "t", {"ri": "hit", "rv": "value"}, "ri", 20)
    same(got, brute_asof(left, right))


def test_running_without_group_and_along_text(frame):
    text = frame.withColumn("z", F.concat(F.lit("id-"), F.sha2(F.col("i").cast("string"), 256)))
    w = Window.partitionBy(F.lit(0)).orderBy("z").rowsBetween(Window.unboundedPreceding, 0)
    want = text.withColumn("n", F.count(F.lit(1)).over(w))
    equal(skew.running(text, [], ["z"], {"n": ("count", "*")}, 20), want)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_equals_join(spark, frame, how):
    table = spark.createDataFrame([("hot", 1), (None, 2), ("k3", 3), ("zz", 4)], "k string, w int")
    on = frame["k"].eqNullSafe(table["k"])
    want = frame.join(table, on, how).drop(table["k"])
    equal(skew.lookup(frame, table, ["k"], how), want)
    equal(skew.lookup(frame, skew.one_per_key(table, ["k"]), ["k"], how), want)


def test_lookup_refuses_different_key_types(spark, frame):
    with pytest.raises(ValueError):
        skew.lookup(frame, spark.createDataFrame([(1, 1)], "t int, w int"), ["t"])


def test_a_key_that_occurs_twice_is_an_error(spark, frame):
    twice = spark.createDataFrame([("hot", 1), ("hot", 1)], "k string, w int")
    with pytest.raises(Exception, match="several rows for one key"):
        joins.enrich(frame, twice, ["k"]).count()


@pytest.mark.parametrize("parts", [None, 50])
def test_counts_ranks_and_copies(frame, parts):
    by = Window.partitionBy("k")
    equal(windows.count_keys(frame, ["k"], "n"), frame.withColumn("n", F.count(F.lit(1)).over(by)))
    want = frame.withColumn("r", F.dense_rank().over(by.orderBy("t")))
    equal(windows.rank_in(frame, ["k"], "t", "r", parts).withColumn("r", F.col("r").cast("int")), want)
    equal(windows.first_ranks(frame, ["k"], "t", 2, "r"), want.filter("r <= 2"))
    copies = frame.select("k", "i")
    want = copies.withColumn("_dup_n", F.row_number().over(by.orderBy("i")).cast("long"))
    equal(windows.mark_duplicate_rows(copies, ["i"], ["k"], parts), want)


def brute_asof(left, right):
    out = []
    for k, t, i in left:
        hits = [(rt, ri, rv) for rk, rt, ri, rv in right if rk == k and rt is not None and t is not None and rt <= t]
        best = max(hits, key=lambda h: (h[0], h[1])) if hits else (None, None, None)
        out.append((k, t, i, best[1], best[2]))
    return out


@pytest.mark.parametrize("parts", [None, 50])
def test_asof_against_brute_force(spark, frame, parts, same):
    data = skewed(900, 3)
    left = [(k, t, i) for k, t, i, _ in data if i % 2]
    right = [(k, t, i, v) for k, t, i, v in data if not i % 2]
    a = spark.createDataFrame(left, "k string, t long, i long")
    b = spark.createDataFrame(right, "k string, t long, ri long, rv double")
    got = joins.asof(a, b, ["k"], "t", {"ri": "hit", "rv": "value"}, "ri", parts)
    same(got, brute_asof(left, right))


def test_quantiles_are_exact(frame):
    values = [r[3] for r in skewed() if r[3] is not None]
    got = quantiles.quantiles(frame, "v", [0, 0.25, 0.5, 0.9, 1])
    assert np.allclose(got, np.quantile(values, [0, 0.25, 0.5, 0.9, 1]))
    assert quantiles.quantiles(frame.filter("1 = 0"), "v", [0.5]) == [None]


def test_quantiles_with_one_value_in_most_rows(spark):
    values = [1.0] * 700 + [float(i) for i in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert np.allclose(quantiles.quantiles(df, "v", [0.1, 0.5, 0.95]), np.quantile(values, [0.1, 0.5, 0.95]))


@pytest.mark.parametrize("few", [5, 300])
def test_quantiles_by_brackets(spark, few):
    import random

    r = random.Random(2)
    for values in (
        [r.random() for _ in range(5000)], [float(r.randrange(7)) for _ in range(3000)], [1.0] * 2000 + [r.random() for _ in range(1000)] + [2.0] * 1500,
        [float(i // 2) for i in range(4000)], [5.0], [1.0, 2.0], [-1e300, 0.0, 1e300] * 400,
    ):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
        asked = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
        assert np.allclose(quantiles.quantiles(df, "v", asked, few), np.quantile(values, asked), rtol=1e-12)


def test_brackets_need_no_range_shuffle(spark, monkeypatch):
    def refused(*_):
        raise AssertionError("all values were counted")

    monkeypatch.setattr(quantiles, "_by_counts", refused)
    df = spark.range(200_000).selectExpr("CAST(xxhash64(id) AS double) AS v", "CAST(id AS int) AS i")
    values = sorted(x[0] for x in df.select("v").collect())
    assert quantiles.quantiles(df, "v", [0.5], 100) == [(values[99_999] + values[100_000]) / 2]
    assert quantiles.quantiles(df, "i", [0.25, 0.75], 100) == [49_999.75, 149_999.25]


def test_quantiles_count_nan_as_the_greatest(spark):
    df = spark.createDataFrame([(float("nan"),)] * 3 + [(float(i),) for i in range(7)], "v double")
    got = quantiles.quantiles(df, "v", [0.0, 0.5, 1.0])
    assert got[:2] == [0.0, 4.5] and np.isnan(got[2])
