"""Event tables loaded as they arrive, one date partition at a time."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from medley.operators.load import overwrite_partitions
from medley.operators.reshape import stack_loose
from medley.operators.skew import lookup, scan, split_groups
from medley.operators.windows import latest


def rewrite_partition(events: DataFrame, path: str, at: str, partition: str = "event_date") -> None:
    """[R01] Batch form: rewrite the date partitions that occur in the frame. Running it again changes nothing."""
    overwrite_partitions(events.withColumn(partition, F.to_date(F.col(at))), path, [partition])


def read_events(
    spark: SparkSession, path: str, schema: T.StructType, name_filter: str | None = None, at: str = "ts", files: int = 200
) -> DataFrame:
    """[R01] A file source as a stream, its event time as a timestamp; a micro-batch takes `files` files at most."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.parquet(path).withColumn(at, F.col(at).cast("timestamp"))


def stream_to_partitions(
    stream: DataFrame, path: str, checkpoint: str, at: str, key: Sequence[str], partition: str = "event_date"
) -> StreamingQuery:
    """[R01, R02] Stream form: every micro-batch lands in its own folder under the date partitions, each key once.

    A key that lies in the table already, in the partition of its date, is left out, however late it comes: rows are
    compared with the table and not with state that a watermark would drop. The folder is named after the query and the
    batch, so a batch that runs again overwrites its own folder only and a new checkpoint none of an earlier one's.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        own = f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{number:010d}"
        rows = batch.withColumn(partition, F.to_date(F.col(at))).dropDuplicates([*key, partition])
        location = spark._jvm.org.apache.hadoop.fs.Path(path)
        if location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location):
            known = spark.read.option("basePath", path).parquet(path).filter(F.col("batch") != own).select(*key, partition)
            rows = lookup(rows, known.withColumn(partition, F.col(partition).cast("date")), [*key, partition], "left_anti")
        overwrite_partitions(rows.withColumn("batch", F.lit(own)), path, ["batch", partition])

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return query.trigger(availableNow=True).start()


def merge_copies(batch: DataFrame, stream: DataFrame, key: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """[R02, W04] Batch and stream copies together, the newest row of each key wins; ours: on a tie the stream."""
    both = stack_loose([batch.withColumn("_from", F.lit(0)), stream.withColumn("_from", F.lit(1))])
    return latest(both, key, [*newest, "_from"]).drop("_from")


def window_counts(
    events: DataFrame, at: str, by: Sequence[str], width: str, slide: str | None = None, delay: str = "1 hour"
) -> DataFrame:
    """[R01] Events per time window, tumbling or sliding; works on a stream and on a table."""
    timed = events.withColumn(at, F.col(at).cast("timestamp"))
    if events.isStreaming:
        timed = timed.withWatermark(at, delay)
    window = F.window(F.col(at), width, slide) if slide else F.window(F.col(at), width)
    counts = timed.groupBy(window.alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n")


def session_counts(events: DataFrame, at: str, by: Sequence[str], gap: str, delay: str = "1 hour") -> DataFrame:
    """[R01] Events per session: a group's events with every gap shorter than `gap`; an event without a time has none.

    On a table sessions are numbered by a scan in parts, so that a group with most of the events is spread over tasks. A
    stream keeps each key's open sessions in its state.
    """
    timed = events.withColumn(at, F.col(at).cast("timestamp"))
    if events.isStreaming:
        window = F.session_window(F.col(at), gap).alias("w")
        counts = timed.withWatermark(at, delay).groupBy(window, *by).agg(F.count(F.lit(1)).alias("n"))
        return counts.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *by, "n")
    wide = F.expr(f"INTERVAL {gap}")
    rows = timed.filter(F.col(at).isNotNull()).select(*by, at)
    seen = scan(split_groups(rows, by, [at]), {"_before": ("previous", at)})
    new = F.when(F.col("_before").isNull() | (F.col(at) >= F.col("_before") + wide), 1)
    numbered = scan(replace(seen, frame=seen.frame.withColumn("_new", new)), {"_session": ("count", "_new")}).frame
    counts = numbered.groupBy(*by, "_session").agg(F.min(at).alias("session_start"), (F.max(at) + wide).alias("session_end"), F.count(F.lit(1)).alias("n"))
    return counts.select("session_start", "session_end", *by, "n")


def run_to_table(result: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Closed windows of a streaming aggregation as Parquet, exactly once."""
    writer = result.writeStream.outputMode("append").format("parquet")
    return writer.option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
