import datetime as dt

import pytest
from pyspark.sql import functions as F

from medley.operators import allocation, load, reconcile


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


def test_mode():
    assert load.mode("I", dt.date(2024, 1, 1)) == "incremental"
    assert load.mode("D", dt.date(2024, 1, 1)) == "full" and load.mode("I", None) == "full"
    with pytest.raises(ValueError):
        load.mode("Q", dt.date(2024, 1, 1))


def test_incremental(spark):
    rows = [(1, dt.datetime(2024, 1, 1, 9)), (2, dt.datetime(2024, 1, 1, 10)), (3, dt.datetime(2024, 1, 2)), (4, None)]
    df = spark.createDataFrame(rows, "k int, at timestamp_ntz")
    mark = dt.datetime(2024, 1, 1, 9, 30)
    ids = lambda d: sorted(r["k"] for r in d.collect())
    assert ids(load.incremental(df, "at", mark)) == [3]
    assert ids(load.incremental(df, "at", mark, "timestamp")) == [2, 3]
    assert ids(load.incremental(df, "at", None)) == [1, 2, 3, 4]
    assert ids(load.incremental(df, "at", dt.date(2030, 1, 1))) == []
    dates = df.select("k", F.to_date("at").alias("at"))
    assert ids(load.incremental(dates, "at", dt.date(2024, 1, 1))) == [3]


def test_merge(spark, same):
    target = frame(spark, [(1, "a"), (2, "b"), (None, "n")])
    source = frame(spark, [(2, "B"), (3, "C"), (None, "N")])
    same(load.merge(target, source, ["k"]), [(1, "a"), (2, "B"), (3, "C"), (None, "N")])
    same(load.merge(target.limit(0), source, ["k"]), [(2, "B"), (3, "C"), (None, "N")])
    same(load.merge(target, source.limit(0), ["k"]), [(1, "a"), (2, "b"), (None, "n")])
    twice = frame(spark, [(2, "x"), (2, "y")])
    with pytest.raises(ValueError):
        load.merge(target, twice, ["k"])
    same(load.merge(target, twice, ["k"], ["v"]), [(1, "a"), (2, "y"), (None, "n")])
    merged = load.merge(target, source, ["k"])
    same(load.merge(merged, source, ["k"]), [tuple(r) for r in merged.collect()])


def test_merge_partitions_rewrites_only_touched(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, "old", i % 3) for i in range(9)]
    spark.createDataFrame(rows, "k int, v string, p int").write.partitionBy("p").parquet(path)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").glob("p=[12]/*.parquet")}
    source = spark.createDataFrame([(0, "new", 0), (30, "new", 0)], "k int, v string, p int")
    assert load.merge_partitions(spark, path, source, ["k"], "p") == 1
    got = {(r["k"], r["v"], r["p"]) for r in spark.read.parquet(path).collect()}
    assert got == {(k, "new" if k == 0 else v, p) for k, v, p in rows} | {(30, "new", 0)}
    assert before == {f: f.stat().st_mtime_ns for f in (tmp_path / "t").glob("p=[12]/*.parquet")}


def test_merge_partitions_null_and_moved_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, "old", "x"), (2, "old", None), (3, "old", None), (4, "old", "y"), (5, "old", "a=b c"), (None, "old", "z")]
    spark.createDataFrame(rows, "k int, v string, p string").write.partitionBy("p").parquet(path)
    source = spark.createDataFrame([(1, "new", "y"), (3, "new", None), (5, "new", "x"), (6, "new", None), (None, "new", "z")], "k int, v string, p string")
    assert load.merge_partitions(spark, path, source, ["k"], "p") == 5
    got = {(r["k"], r["v"], r["p"]) for r in spark.read.parquet(path).collect()}
    assert got == {(1, "new", "y"), (2, "old", None), (3, "new", None), (4, "old", "y"), (5, "new", "x"), (6, "new", None), (None, "new", "z")}


def test_few_files_per_partition(spark, tmp_path):
    rows = spark.range(3000).repartition(16).withColumn("p", F.col("id") % 30)
    load.overwrite_partitions(rows, str(tmp_path / "t"), ["p"])
    assert len(list((tmp_path / "t").glob("p=*/*.parquet"))) <= 60


def test_vanished(spark, same):
    target = frame(spark, [(1, "in"), (2, "in"), (3, "out"), (None, "in"), (4, None)])
    source = frame(spark, [(1, "x")])
    inside = F.col("v") == "in"
    same(load.vanished(target, source, ["k"], inside), [(2, "in")])
    same(load.delete_vanished(target, source, ["k"], inside), [(1, "in"), (3, "out"), (None, "in"), (4, None)])


def test_replace(spark, same):
    target = spark.createDataFrame([("A", 1, "o"), ("A", 2, "o"), ("B", 1, "o"), (None, 1, "o")], "c string, p int, v string")
    new = spark.createDataFrame([("A", 1, "n"), ("C", 9, "n")], target.schema)
    want = [("A", 2, "o"), ("B", 1, "o"), (None, 1, "o"), ("A", 1, "n"), ("C", 9, "n")]
    same(load.replace_period(target, new, ["c", "p"]), want)
    same(load.replace_slice(target, new, F.col("c") == "A"), [("B", 1, "o"), (None, 1, "o"), ("A", 1, "n"), ("C", 9, "n")])


def test_checked_overwrite_stage_and_log(spark, tmp_path, same):
    path = str(tmp_path / "t")
    assert load.checked_overwrite(spark.range(3), spark.range(3), path) == 3
    with pytest.raises(ValueError):
        load.checked_overwrite(spark.range(4), spark.range(3), path)
    load.stage_append(spark.range(3, 5), path, lambda d: d.filter("id > 3"))
    assert spark.read.parquet(path).count() == 4
    now = dt.datetime(2024, 1, 1)
    assert load.process_log(spark, "f", 3, "c", "s", now, now, "OK").first()["status"] == "OK"


def test_entities(spark):
    a, b = frame(spark, [(1, "a")]), frame(spark, [(1, "b")])
    got = load.merge_entities({"x": a, "y": b}, {"x": frame(spark, [(1, "z")])}, {"x": ["k"], "y": ["k"]})
    assert got["x"].first()["v"] == "z" and got["y"].first()["v"] == "b"


def test_reconcile(spark, same):
    a = frame(spark, [(1, "x"), (1, "y"), (2, "x"), (None, "x")])
    b = frame(spark, [(1, "x"), (3, "x"), (None, "y")])
    got = reconcile.counts_by_key(a, b, ["k"]).select("k", "n_a", "n_b", "status", "diff")
    same(got, [(1, 2, 1, "differ", 1), (2, 1, 0, "only_a", 1), (3, 0, 1, "only_b", -1), (None, 1, 1, "match", 0)])
    assert reconcile.require_equal(spark.range(2), spark.range(2)) == 2
    with pytest.raises(ValueError):
        reconcile.require_equal(spark.range(2), spark.range(1))


def test_value_drift(spark, same):
    t = spark.createDataFrame([(1, "a"), (1, "b"), (None, None), (2, "a")], "n int, s string")
    config = [("t", "n", ["1", "3"]), ("t", "s", ["a", "b"])]
    got = reconcile.value_drift({"t": t}, config, dt.date(2024, 1, 1)).select("column", "kind", "items")
    same(got, [("n", "New Values", ["2"]), ("n", "Missing Values", ["3"])])
    strict = reconcile.value_drift({"t": t}, config, dt.date(2024, 1, 1), null_is_value=True)
    assert strict.filter("column = 's' and kind = 'New Values'").first()["items"] == ["None"]


def test_error_reports(spark, same):
    lines = spark.createDataFrame([(" https://a/graphql.json  broken",), ("ok",), (None,), ("u/graphql.json",)], "line string")
    got = reconcile.error_reports(lines, "line", "/graphql.json", dt.date(2024, 1, 1)).select("url", "error_message")
    same(got, [("https://a/graphql.json", "broken"), ("u/graphql.json", "")])


def test_allocation_conserves_totals(spark, same):
    sales = spark.createDataFrame([("p", 10.0), ("q", 5.0), (None, 1.0)], "p string, amount double")
    weights = spark.createDataFrame([("p", "x", 0.25), ("p", "y", 0.75)], "p string, area string, w double")
    got = allocation.allocate(sales, weights, ["p"], "area", "w", "amount")
    same(got.select("p", "area", "amount"), [("p", "x", 2.5), ("p", "y", 7.5), ("q", None, 5.0), (None, None, 1.0)])
    assert allocation.bad_weights(weights, ["p"], "w").count() == 0
    assert allocation.bad_weights(weights.filter("area = 'x'"), ["p"], "w").count() == 1
    with pytest.raises(Exception, match="do not sum to 1"):
        allocation.allocate(sales, weights.filter("area = 'x'"), ["p"], "area", "w", "amount").count()
    levels = allocation.roll_up(got.fillna("none"), ["p", "area"], "amount")
    assert levels["p"].agg(F.sum("amount")).first()[0] == 16.0
