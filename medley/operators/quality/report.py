"""What the gate reports. Counts are map-side aggregates; nothing data-sized reaches the driver."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medley.functions.text import priority_level
from medley.operators.project import sanitise_names
from medley.operators.quality.rules import Rule

# Types of check in the summary, with the text shown for each.
CHECK_TYPES = [
    ("numeric", "Numeric check", "Non numeric value found"),
    ("date", "Date check", "Invalid date"),
    ("duplicate", "Duplicate check", "Duplicate record Found"),
    ("valid_value", "Valid value check", "Invalid value(s) found"),
    ("mandatory", "Null check", "Mandatory value is missing"),
]

# Columns the error table adds to the data, in lower case.
ADDED = {
    "priority_level", "error_description", "filename", "record_number", "processed_date", "notebook_name", "status"
}

CUSTOM_KINDS = ("custom", "history", "expr")
KEEP_DAYS = 3


def render(errors: Column) -> Column:
    """[Q04, U06] Errors as text: `mail_group-message`, joined by `;`; null without errors."""
    texts = F.transform(errors, lambda e: F.concat(e["mail_group"], F.lit("-"), e["message"]))
    return F.when(F.size(errors) > 0, F.array_join(texts, ";"))


def priorities(errors: Column) -> Column:
    """[Q04] The priorities of a row's errors, joined by `;`; null without errors."""
    return F.when(F.size(errors) > 0, F.array_join(F.transform(errors, lambda e: e["priority"]), ";"))


def error_columns(errors: Column) -> Column:
    """[Q28] The columns a row's errors name, each once, in order of first mention."""
    return F.array_distinct(F.filter(F.transform(errors, lambda e: e["column"]), lambda c: c.isNotNull()))


def priority_flags(tagged: DataFrame) -> DataFrame:
    """[Q20] One row of flags: high, medium, low."""
    named = F.upper(priorities(F.col("errors")))
    return tagged.filter(F.size("errors") > 0).select(named.alias("p")).agg(
        *[
            F.coalesce(F.bool_or(F.contains("p", F.lit(level.upper()))), F.lit(False)).alias(level)
            for level in ("high", "medium", "low")
        ]
    )


def error_rows(
    invalid: DataFrame, columns: Sequence[str], key: Sequence[str], file: str, process: str, run_time: dt.datetime
) -> DataFrame:
    """[Q18, P04] Data columns, priorities, description, file, record number, date, process and status.

    The record number is the row's declared key as text. A data column with the name of one of the added
    columns gets a leading underscore.
    """
    data = sanitise_names(invalid.select(*columns))
    names = [f"_{n}" if n.lower() in ADDED else n for n in data.columns]
    rows = invalid.select(
        *[F.col(f"`{a}`").alias(b) for a, b in zip(columns, names, strict=True)],
        priorities(F.col("errors")).alias("priority_level"),
        render(F.col("errors")).alias("ERROR_DESCRIPTION"),
        F.lit(file).alias("FILENAME"),
        F.concat_ws("/", *[F.col(f"`{k}`").cast("string") for k in key]).alias("RECORD_NUMBER"),
        F.lit(run_time).alias("PROCESSED_DATE"),
        F.lit(process).alias("NOTEBOOK_NAME"),
        F.lit(None).cast("string").alias("status"),
    )
    return rows


def refresh_error_table(
    existing: DataFrame, new: DataFrame, file: str, today: dt.date, keep_days: int = KEEP_DAYS
) -> DataFrame:
    """[Q19] The error table without earlier rows of the file and rows older than `keep_days`, plus the new."""
    kept = existing.filter(
        (F.lower("FILENAME") != file.lower())
        & (F.to_date("PROCESSED_DATE") >= F.lit(today - dt.timedelta(days=keep_days)))
    )
    return kept.unionByName(new)


def summary(
    errors: DataFrame, total: int, country: str, source: str, error_table: str, error_file: str, source_path: str
) -> DataFrame:
    """[Q24] Error rows by description, written once for all grades."""
    keyed = errors.withColumns({"country_code": F.lit(country), "data_source_name": F.lit(source)})
    counts = keyed.groupBy(
        "country_code",
        "data_source_name",
        F.col("FILENAME").alias("filename"),
        F.col("ERROR_DESCRIPTION").alias("error_description"),
        F.col("PROCESSED_DATE").alias("processed_date"),
        F.col("NOTEBOOK_NAME").alias("notebook_name"),
    ).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumns(
        {
            "error_table_name": F.lit(error_table),
            "error_file": F.lit(error_file),
            "email_status": F.lit(None).cast("string"),
            "total_record": F.lit(total),
            "source_path": F.lit(source_path),
        }
    )


def _errors(tagged: DataFrame) -> DataFrame:
    return tagged.select(F.explode("errors").alias("e")).select("e.*")


def by_check(tagged: DataFrame) -> DataFrame:
    """[Q25] Number of errors per type of check, zero included.

    The five types are stacked as zero rows under the counts, which needs no join.
    """
    spark = tagged.sparkSession
    types = spark.createDataFrame(CHECK_TYPES, "check string, error_type string, description string")
    found = _errors(tagged).groupBy("check").agg(F.count(F.lit(1)).alias("n"))
    return types.join(found, "check", "left").select(
        "check", "error_type", "description", F.coalesce("n", F.lit(0)).alias("error_records")
    )


def custom_summary(tagged: DataFrame) -> DataFrame:
    """[Q26] Errors of custom checks by the text of the message after its first `#` (all of it without one) and mail group."""
    custom = _errors(tagged).filter(F.col("check").isin(*CUSTOM_KINDS))
    text = F.regexp_replace("message", "^[^#]*#", "").alias("message")
    return custom.groupBy(text, "mail_group").agg(F.count(F.lit(1)).alias("error_records"))


def validation_log(tagged: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """[Q27] One row per rule: failing columns in the rule's order, and TRUE if none failed."""
    spark = tagged.sparkSession
    listed = spark.createDataFrame(
        [(i, r.name, r.kind, r.subject, list(r.columns)) for i, r in enumerate(rules)],
        "rule_no int, rule string, check string, subject string, columns array<string>",
    )
    # At most one value per rule and column reaches a list.
    failed = (
        _errors(tagged)
        .groupBy("rule_no", F.coalesce("column", F.lit("")).alias("column"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("rule_no")
        .agg(F.collect_set("column").alias("failed"), F.sum("n").alias("errors"))
    )
    rows = listed.join(failed, "rule_no", "left")
    named = F.filter("columns", lambda c: F.array_contains("failed", c))
    text = F.when(F.size(named) > 0, F.concat("subject", F.lit(": "), F.array_join(named, ","))).otherwise(
        F.when(F.col("errors") > 0, F.col("subject")).otherwise("")
    )
    return rows.select(
        "rule_no",
        "rule",
        "check",
        F.coalesce(text, F.lit("")).alias("error_text"),
        F.coalesce("errors", F.lit(0)).alias("errors"),
        F.when(F.coalesce("errors", F.lit(0)) == 0, "TRUE").otherwise("FALSE").alias("status"),
    )


def by_grade(errors: DataFrame) -> DataFrame:
    """[Q21] Error-table rows with their grade."""
    return errors.withColumn("grade", priority_level(F.col("priority_level")))


def mark_processed(errors: DataFrame, grade: str, file: str | None = None) -> DataFrame:
    """[Q29] Open rows of a grade (of one file, if given) get the status `processed`."""
    hit = F.col("status").isNull() & (priority_level(F.col("priority_level")) == grade)
    if file is not None:
        hit = hit & (F.lower("FILENAME") == file.lower())
    return errors.withColumn("status", F.when(hit, "processed").otherwise(F.col("status")))


def mark_sent(summary_rows: DataFrame, file: str) -> DataFrame:
    """[Q29] Summary rows of a file get the e-mail status `sent`."""
    return summary_rows.withColumn(
        "email_status", F.when(F.col("filename") == file, "sent").otherwise(F.col("email_status"))
    )


def export_frame(
    invalid: DataFrame, columns: Sequence[str], key: Sequence[str], grade: str, file: str, process: str, run_time: dt.datetime
) -> DataFrame:
    """[Q30] One line per error of the rows of a grade, each with its own mail group, message and priority."""
    rows = invalid.filter(F.col("grade") == grade).withColumn("_e", F.explode("errors"))
    alone = rows.withColumn("errors", F.array("_e")).withColumn("_mail", F.col("_e.mail_group")).withColumn("_text", F.col("_e.message"))
    lines = error_rows(alone, [*columns, "_mail", "_text"], key, file, process, run_time).drop("status")
    return lines.withColumn("ERROR_DESCRIPTION", F.col("_text")).withColumnRenamed("_mail", "mail_group").drop("_text")


def export_by_grade(
    invalid: DataFrame, columns: Sequence[str], key: Sequence[str], path: str, file: str, process: str, run_time: dt.datetime
) -> list[str]:
    """[Q30] CSV output per grade, named after the file and the grade. A grade may span several files."""
    written = []
    for grade in ("high", "medium", "low"):
        target = f"{path.rstrip('/')}/err_{file.lower().split('.')[0]}_{grade}"
        lines = export_frame(invalid, columns, key, grade, file, process, run_time)
        lines.write.mode("overwrite").option("header", True).csv(target)
        written.append(target)
    return written


def totals_by_file(summary_rows: DataFrame) -> DataFrame:
    """[Q32, A18, A19] Errors, distinct files and total records over the summary table."""
    per_file = summary_rows.groupBy("filename").agg(
        F.sum("count").alias("errors"), F.max("total_record").alias("records")
    )
    return per_file.agg(
        F.sum("errors").alias("errors"), F.count("filename").alias("files"), F.sum("records").alias("records")
    )
