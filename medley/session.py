"""Session factory and the one place that decides where intermediate tables live."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build(app: str = "medley", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume: UTC, ANSI, AQE, Arrow."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.ui.enabled": "false",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a cluster a
    machine-local folder would be lost with its machine, so a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    named = tempfile.mkdtemp(prefix="medley-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


_MADE: list[str] = []


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one table inside the shared folder."""
    path = f"{work_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def clear(spark: SparkSession) -> int:
    """Remove the intermediate tables that this process has written, and say how many paths that were.

    To be called when the results that read them have been written; frames built on them cannot be read afterwards.
    """
    done = len(_MADE)
    while _MADE:
        location = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)
    return done


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, label: str = "table") -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    Use it where several outputs need the same expensive frame. The written table survives
    the loss of an executor and keeps column pruning and filter pushdown for its readers.
    Its shuffle files are of no use once it is written, so Spark is asked to remove them then
    and not whenever the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    before = spark.conf.get(CLEANUP, None)
    if before is not None:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is not None:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
