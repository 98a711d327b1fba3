"""The whole run for one delivered file: rules from the tables, gate, error table, summary, exports, load."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from medley.operators import load
from medley.operators.quality import report
from medley.operators.quality.dates import LocalFormat
from medley.operators.quality.gate import GateResult, gate
from medley.operators.quality.rules import MAX_RULES, select_rules, structure_check, to_rules


class StructureError(Exception):
    """A file's columns are not those expected; it must not be loaded."""


class HighPriorityError(Exception):
    """A file has rows with high errors; it must not be loaded."""


@dataclass(frozen=True)
class Delivery:
    """What is known about one delivered file."""

    file: str
    file_format: str
    country: str
    source: str
    process: str
    run_time: dt.datetime
    source_path: str = ""


@dataclass(frozen=True)
class Outcome:
    """Rows to load, where the error table is, whether a high error stops the load, and the gate itself."""

    valid: DataFrame
    error_path: str
    high_flag: bool
    result: GateResult | None


def local_formats(table: DataFrame, country: str) -> list[LocalFormat]:
    """[Q13, Q15] Local date formats of a country, in table order; a small configuration table."""
    rows = table.filter(table["country_code"] == country).limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} date formats for {country}")
    return [
        LocalFormat(r["local_date_format"], r["timestamp_flag"] == "Y", r["active_flag"], r["filename_format"])
        for r in rows
    ]


def check_file(
    df: DataFrame,
    rules: DataFrame,
    key: Sequence[str],
    delivery: Delivery,
    error_table: str,
    summary_table: str,
    formats: DataFrame | None = None,
    views: Mapping[str, DataFrame] | None = None,
    previous: DataFrame | None = None,
    export: str | None = None,
    expected: Sequence[str] | None = None,
    ignore_case: bool = False,
) -> Outcome:
    """[Q01, Q02, Q17 to Q24, Q29, Q30] Check a file and keep the books.

    Without a matching rule the data passes unchanged. The tagged rows are written once and every output
    reads that copy. The error table and the summary hold one folder per day and file (names compared without case): a
    run replaces its own file's rows only, earlier days of the file included, and drops error days older than three, so
    runs of different files neither read nor overwrite each other's.

    `expected` are the columns that a `structure_check` rule asks for: a file with others is refused before it is read.
    """
    chosen = select_rules(rules, delivery.country, delivery.source, delivery.file, delivery.file_format)
    if expected is not None and not chosen.filter("rule_name = 'structure_check'").isEmpty():
        if not structure_check(df.columns, expected, ignore_case):
            raise StructureError(f"{delivery.file} has columns {df.columns}, expected {list(expected)}")
    picked = to_rules(chosen)
    if not picked:
        return Outcome(df, "", False, None)
    found = local_formats(formats, delivery.country) if formats is not None else []
    done = gate(df, picked, key, delivery.file, found, views, previous).materialised()
    day = delivery.run_time.date()
    errors = done.error_rows(delivery.file, delivery.process, delivery.run_time)
    load.replace_file(errors, error_table, day, delivery.file, keep_days=report.KEEP_DAYS)
    rows = report.summary(
        errors, done.tagged.count(), delivery.country, delivery.source, error_table, export or "", delivery.source_path
    )
    load.replace_file(rows, summary_table, day, delivery.file)
    if export:
        report.export_by_grade(done.invalid, done.columns, done.key, export, delivery.file, delivery.process, delivery.run_time)
    return Outcome(done.valid, error_table, done.high_flag(), done)


def load_file(
    outcome: Outcome, target: DataFrame, key: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    """[Q23, L05] Merge the rows that passed into the target; a high error stops the load."""
    if outcome.high_flag:
        raise HighPriorityError(f"high errors, see {outcome.error_path}")
    return load.merge(target, outcome.valid, key, order_by)
