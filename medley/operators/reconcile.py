"""Reconciliation and drift checks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medley.functions.text import error_report
from medley.operators import aggregates
from medley.operators.joins import compare_totals
from medley.operators.reshape import stack, stack_tagged


def require_equal(a: DataFrame, b: DataFrame) -> int:
    """[C03] Raise unless both frames have the same number of rows; returns that number."""
    row = compare_totals(a, b).first()
    if not row["equal"]:
        raise ValueError(f"{row['rows_a']} rows against {row['rows_b']}")
    return row["rows_a"]


def loaded_vs_raw(lines: DataFrame, path: str, loaded: DataFrame, day: str) -> DataFrame:
    """[C01, A20] Raw lines and loaded rows of each day, and whether they agree."""
    raw = aggregates.line_counts(lines, path).withColumnRenamed("raw_line_count", "n")
    have = loaded.groupBy(F.col(day).alias("report_date")).agg(F.count(F.lit(1)).alias("n"))
    return _compare(raw, have, ["report_date"])


def counts_by_key(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """[C02, A21] Row counts by key on both sides, their difference and a status.

    Each side is counted first; the counts are stacked and summed, which is a full outer join with
    null keys matched and without a join. Ours: status is match, differ, only_a or only_b.
    """
    left = a.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    right = b.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return _compare(left, right, keys)


def _compare(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    both = left.select(*keys, F.col("n").alias("n_a")).unionByName(
        right.select(*keys, F.col("n").alias("n_b")), allowMissingColumns=True
    )
    out = both.groupBy(*keys).agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))
    status = (
        F.when(F.col("n_b").isNull(), "only_a")
        .when(F.col("n_a").isNull(), "only_b")
        .when(F.col("n_a") == F.col("n_b"), "match")
        .otherwise("differ")
    )
    filled = out.withColumn("status", status).fillna(0, subset=["n_a", "n_b"])
    return filled.withColumn("diff", F.col("n_a") - F.col("n_b"))


def drift_rows(
    tables: Mapping[str, DataFrame],
    config: Sequence[tuple[str, str, Sequence[str]]],
    null_is_value: bool = False,
) -> DataFrame:
    """[C04, J07, J12] New and missing values of configured columns against their allowed lists, as rows.

    Both sides are compared as text. A column is reduced to its distinct values before it meets the list;
    values are compared against one combined list of (table, column, value).
    """
    spark = next(iter(tables.values())).sparkSession
    parts = []
    for table, column, _ in config:
        value = F.col(column).cast("string")
        found = tables[table].select(value.alias("value")).distinct()
        found = found.fillna("None") if null_is_value else found.filter("value is not null")
        parts.append(found.select(F.lit(table).alias("table"), F.lit(column).alias("column"), "value"))
    allowed = spark.createDataFrame(
        [(t, c, str(v)) for t, c, vs in config for v in sorted(set(vs))], "table string, column string, value string"
    )
    sides = stack(parts).withColumn("_new", F.lit(1)).unionByName(allowed.withColumn("_new", F.lit(-1)))
    odd = sides.groupBy("table", "column", "value").agg(F.sum("_new").alias("s")).filter("s <> 0")
    kind = F.when(F.col("s") > 0, "New Values").otherwise("Missing Values")
    return odd.select("table", "column", kind.alias("kind"), "value")


def value_drift(
    tables: Mapping[str, DataFrame],
    config: Sequence[tuple[str, str, Sequence[str]]],
    today: dt.date,
    null_is_value: bool = False,
) -> DataFrame:
    """[C04, A16] One row per (table, column, kind) with a sorted array, none where nothing differs.

    For columns of few values, as each list is one cell; `drift_rows` gives rows and takes any number.
    """
    rows = drift_rows(tables, config, null_is_value)
    sets = aggregates.value_sets(rows, ["table", "column", "kind"], "value")
    return sets.withColumn("report_date", F.lit(today))


def volume_metrics(
    tables: Mapping[str, DataFrame],
    config: Sequence[tuple[str, str, str, str | None]],
    today: dt.date,
    watermarks: Mapping[str, dt.date] | None = None,
) -> DataFrame:
    """[C05, A13, A14] Daily volumes for the training table, from (table, day, metric, key) entries.

    One aggregation per source table; rows are (table, column, day, key, metric), the key null where none
    is configured.
    """
    marks = watermarks or {}
    parts = []
    for table, at, metric, key in config:
        rows = aggregates.daily_metric(tables[table], at, metric, today, marks.get(table), key)
        parts.append(
            rows.select(
                F.lit(table).alias("table"),
                F.lit(metric).alias("column"),
                "day",
                (F.col(key).cast("string") if key else F.lit(None).cast("string")).alias("key"),
                "metric",
            )
        )
    return stack(parts)


def error_reports(lines: DataFrame, column: str, marker: str, report_date: dt.date) -> DataFrame:
    """[C06] Error lines that carry the marker, as (url, error_message, report_date)."""
    url, message = error_report(F.col(column), marker)
    return lines.filter(F.contains(F.col(column), F.lit(marker))).select(
        url.alias("url"), message.alias("error_message"), F.lit(report_date).alias("report_date")
    )


def all_error_reports(reports: Mapping[str, DataFrame], load_time: dt.datetime) -> DataFrame:
    """[C07, T02] Error reports of all batches with batch name and load time."""
    return stack_tagged(reports, "source", F.lit(load_time))


def failed_requests(responses: DataFrame, request: str, status: str) -> DataFrame:
    """[C08] Requests that failed, as JSON text with their context, for the next run."""
    return responses.filter(F.col(status) >= 400).select(F.to_json(request).alias("context"))


def retry_requests(failed: DataFrame, schema: str) -> DataFrame:
    """[C08] Failed requests read back and made distinct."""
    return failed.select(F.from_json("context", schema).alias("r")).select("r.*").distinct()
