"""Functions over grouped and cogrouped frames, against Spark's own grouped maps, with a group that holds a third of the rows."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from medley.operators import batches

N = 3000


@pytest.fixture(scope="module")
def sides(spark):
    base = spark.range(N).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40 + 100).alias("g"), "id")
    left = base.filter("id % 2 = 0").select("g", (F.col("id") * 7 % 1000).alias("at"), F.col("id").alias("a"))
    right = base.filter("id % 5 < 2").select("g", (F.col("id") * 11 % 1000).alias("at"), (F.col("id") * 10).alias("b"))
    return left.cache(), right.cache()


def make_last_before():
    def last_before(left, right, before):  # made here, so that workers get it by value
        seen = pd.concat([before, right[["at", "b"]]]).astype({"at": "int64", "b": "Int64"})
        return pd.merge_asof(left, seen, on="at")

    return last_before


last_before = make_last_before()
LAST = batches.Carry("at long, b long", lambda left, right: right[["at", "b"]].tail(1), lambda before, own: own if len(own) else before)


def test_cogrouped_map_equals_whole_groups(sides, same):
    left, right = sides

    def whole(a, b):
        a, b = a.sort_values("at"), b.sort_values(["at", "b"])
        return last_before(a, b, b[["at", "b"]].head(0))[["g", "a", "b"]]

    want = left.groupBy("g").cogroup(right.groupBy("g")).applyInPandas(whole, "g long, a long, b long").collect()
    for rows in (10**6, 150):
        got = batches.cogrouped_map(left, right, ["g"], ["at"], last_before, "g long, a long, b long", LAST, tie=["b"], rows=rows)
        same(got, want)


def test_a_hot_group_is_spread(sides):
    left, right = sides

    def sizes(left, right, before):
        return pd.DataFrame({"g": [left.g.iloc[0] if len(left) else right.g.iloc[0]], "n": [len(left) + len(right)], "carried": [len(before)]})

    got = batches.cogrouped_map(left, right, ["g"], ["at"], sizes, "g long, n long, carried long", LAST, rows=150).toPandas()
    hot = got[got.g == 7]
    assert len(hot) >= 4 and hot.n.max() <= 450 and (hot.carried == 0).sum() == 1
    assert got.n.sum() == left.count() + right.count()


def test_carried_through_parts_that_leave_nothing(spark, same):
    left = spark.createDataFrame([(1, t) for t in range(400)], "g long, at long")
    right = spark.createDataFrame([(1, 0, 5)], "g long, at long, b long")
    got = batches.cogrouped_map(left, right, ["g"], ["at"], last_before, "at long, b long", LAST, rows=40)
    same(got, [(t, 5) for t in range(400)])


def test_one_sided_and_empty(spark, sides, same):
    left, right = sides
    schema = "g long, a long, b long"
    none = batches.cogrouped_map(left, right.limit(0), ["g"], ["at"], last_before, schema, LAST)
    same(none, [(r.g, r.a, None) for r in left.collect()])
    assert batches.cogrouped_map(left.limit(0), right.limit(0), ["g"], ["at"], last_before, schema, LAST).count() == 0


def mean():
    of = lambda rows: pd.DataFrame({"n": [rows.a.count()], "total": [rows.a.sum()]})
    return batches.Summary("n long, total long", of, lambda a, b: pd.DataFrame({c: [a[c].iloc[0] + b[c].iloc[0]] for c in a.columns}))


def test_grouped_map_equals_whole_groups(spark, sides, same):
    left = sides[0].repartition(5)
    want = left.groupBy("g").applyInPandas(lambda rows: rows.assign(off=rows.a - rows.a.mean())[["g", "a", "off"]], "g long, a long, off double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 64)
    try:
        got = batches.grouped_map(left, ["g"], mean(), lambda rows, whole: rows.assign(off=rows.a - whole.total.iloc[0] / whole.n.iloc[0]), "g long, a long, off double")
        same(got.withColumn("off", F.round("off", 9)), want.withColumn("off", F.round("off", 9)).collect())
        longest = batches.grouped_map(left, ["g"], mean(), lambda rows, whole: pd.DataFrame({"n": [len(rows)]}), "n long").agg(F.max("n")).first()[0]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert longest <= 64
    assert batches.grouped_map(left.limit(0), ["g"], mean(), lambda rows, whole: rows, "g long, at long, a long").count() == 0
