import datetime as dt

from pyspark.sql import functions as F

from medley.streaming import hourly

BASE = dt.datetime(2024, 1, 1)


def events(spark, path, n=400):
    rows = [(i, BASE + dt.timedelta(minutes=13 * i), i % 5, "a" if i % 3 else "b") for i in range(n)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, user int, kind string")
    df.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def test_stream_equals_batch_on_closed_windows(spark, tmp_path, same):
    src = str(tmp_path / "src")
    batch = events(spark, src)
    stream = hourly.read_events(spark, src, batch.schema)
    counts = hourly.window_counts(stream, "ts", ["kind"], "6 hours")
    hourly.run_to_table(counts, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    want = hourly.window_counts(batch, "ts", ["kind"], "6 hours")
    closed = got.agg(F.max("window_end")).first()[0]
    assert got.count() > 10
    same(got, want.filter(F.col("window_end") <= F.lit(closed)).collect())


def test_sessions_stream_equals_batch(spark, tmp_path, same):
    src = str(tmp_path / "src")
    batch = events(spark, src).filter("id % 40 < 20")
    stream = hourly.read_events(spark, src, batch.schema).filter("id % 40 < 20")
    counts = hourly.session_counts(stream, "ts", ["user"], "90 minutes")
    hourly.run_to_table(counts, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    want = hourly.session_counts(batch, "ts", ["user"], "90 minutes").collect()
    rows = {tuple(r) for r in got.collect()}
    assert len(rows) > 10 and rows <= {tuple(r) for r in want}


def test_late_events_restarts_and_new_queries(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    batch = events(spark, src)

    def run(checkpoint):
        stream = hourly.read_events(spark, src, batch.schema, files=1)
        hourly.stream_to_partitions(stream, out, checkpoint, "ts", ["id"]).awaitTermination()

    run(cp)
    run(cp)
    late = [(1000, BASE + dt.timedelta(minutes=1), 1, "c")] * 2 + [(7, BASE + dt.timedelta(minutes=91), 2, "a")]  # days behind; 7 is known
    spark.createDataFrame(late, batch.schema).coalesce(1).write.mode("append").parquet(src)
    run(cp)
    run(str(tmp_path / "another"))  # a fresh checkpoint reads all again
    got = spark.read.parquet(out)
    assert got.count() == 401 and got.select("id").distinct().count() == 401
    days = got.groupBy(F.to_date("ts").alias("d"), F.to_date("event_date").alias("e")).count()
    assert days.filter("d <> e").count() == 0


def test_batch_rewrite_is_idempotent(spark, tmp_path):
    batch = events(spark, str(tmp_path / "src"))
    for _ in range(2):
        hourly.rewrite_partition(batch, str(tmp_path / "out"), "ts")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 400


def test_newest_copy_wins(spark, same):
    a = spark.createDataFrame([(1, 5, "b"), (2, 1, "b")], "k int, v int, src string")
    b = spark.createDataFrame([(1, 5, "s"), (2, 0, "s"), (3, 1, "s")], "k int, v int, src string")
    same(hourly.merge_copies(a, b, ["k"], ["v"]), [(1, 5, "s"), (2, 1, "b"), (3, 1, "s")])
