"""The gate itself: tag every row with why it fails, then split."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medley.functions.text import priority_level
from medley.operators import project
from medley.operators.quality import checks, report
from medley.operators.quality.dates import LocalFormat, normalise_dates
from medley.operators.quality.rules import Rule
from medley.operators.skew import lookup
from medley.operators.windows import count_keys, fingerprint
from medley.session import materialise

# Grades of a row, in ascending order.
LEVELS = ("ok", "low", "medium", "high")

ROW = "_row_id"
FINGERPRINT = "_fp"

ERROR = "struct<rule_no:int,rule:string,check:string,column:string,message:string,priority:string,mail_group:string>"


@dataclass(frozen=True)
class GateResult:
    """Outcome of a gate. Frames are lazy; `materialised` writes the tagged rows once for many readers."""

    tagged: DataFrame
    rules: tuple[Rule, ...]
    columns: tuple[str, ...]
    key: tuple[str, ...]

    def materialised(self) -> GateResult:
        """The same result over a written copy of the tagged rows."""
        return replace(self, tagged=materialise(self.tagged, "tagged"))

    @property
    def valid(self) -> DataFrame:
        """[Q17, Q22] Rows without errors and rows with low errors only, input columns only."""
        return self.tagged.filter(F.col("grade").isin("ok", "low")).select(*self.columns)

    @property
    def held(self) -> DataFrame:
        """[Q17, Q22] Rows with a medium or high error."""
        return self.tagged.filter(F.col("grade").isin("medium", "high"))

    @property
    def invalid(self) -> DataFrame:
        """[Q17] Every row with an error, of any grade."""
        return self.tagged.filter(F.size("errors") > 0)

    def high_flag(self) -> bool:
        """[Q23] True if any row carries a high error: the load must stop."""
        return bool(self.flags().first()["high"])

    def flags(self) -> DataFrame:
        """[Q20] One row: does any error carry high, medium, low."""
        return report.priority_flags(self.tagged)

    def error_rows(self, file: str, process: str, run_time: dt.datetime) -> DataFrame:
        """[Q18] Rows of the error table."""
        return report.error_rows(self.invalid, self.columns, self.key, file, process, run_time)

    def log(self) -> DataFrame:
        """[Q27] One row per rule."""
        return report.validation_log(self.tagged, self.rules)

    def by_check(self) -> DataFrame:
        """[Q25] Errors by type of check."""
        return report.by_check(self.tagged)

    def custom(self) -> DataFrame:
        """[Q26] Errors of custom checks by message."""
        return report.custom_summary(self.tagged)


def grade_of(priority: str) -> str:
    """[X28] Grade of a rule's priority text: high over medium over low."""
    return next((g for g in ("high", "medium") if g in priority.lower()), "low")


def _error(number: int, rule: Rule, column: str, message: Column | str, priority: Column | str) -> Column:
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(
        F.lit(number).alias("rule_no"),
        F.lit(rule.name).alias("rule"),
        F.lit(rule.kind).alias("check"),
        F.lit(column).cast("string").alias("column"),
        lit(message).alias("message"),
        lit(priority).alias("priority"),
        F.lit(rule.mail_group).alias("mail_group"),
    )


def _mark_duplicates(df: DataFrame, rule: Rule, out: str, key: Sequence[str]) -> DataFrame:
    """[Q09] Flag duplicates: every row of a repeated key, or all but the first of equal rows.

    The first of equal rows is the one with the smallest key, and of rows that share that too any one. Both forms count
    with a map-side aggregate and look the few repeated groups up, so no task sorts a whole group.
    """
    if rule.items:
        counted = count_keys(df, rule.items, "_n")
        return counted.withColumn(out, F.col("_n") > 1).drop("_n")
    first = F.min(F.struct(*key, ROW))[ROW].alias("_first")
    repeated = df.groupBy(FINGERPRINT).agg(F.count(F.lit(1)).alias("_n"), first).filter("_n > 1").drop("_n")
    found = lookup(df, materialise(repeated, "copies"), [FINGERPRINT])
    return found.withColumn(out, F.col("_first").isNotNull() & (F.col("_first") != F.col(ROW))).drop("_first")


def _run_query(df: DataFrame, number: int, rule: Rule, views: Mapping[str, DataFrame], key: Sequence[str]) -> DataFrame:
    """[Q10, Q11] A custom query over the data; it adds `processing_status_2` and `priority_status_2`.

    Only its messages are taken, back to the rows by key: a query that filters or joins neither loses nor doubles a row.
    Rows that share a key share all messages of that key.
    """
    out = df.sparkSession.sql(str(rule.arg), data=df, **views)
    want = set(df.columns) | {"processing_status_2", "priority_status_2"}
    if set(out.columns) != want:
        raise ValueError(f"{rule.name} must return the data's columns plus the two status columns")
    priority = F.coalesce("priority_status_2", F.lit(rule.priority))
    level = F.array_position(F.array(*[F.lit(v) for v in LEVELS]), priority_level(priority)).cast("int") - 1
    error = _error(number, rule, None, F.col("processing_status_2"), priority).cast(ERROR)
    failed = out.filter(F.col("processing_status_2").isNotNull()).select(*key, error.alias("_e"), level.alias("_l"))
    # different messages of one key: as many as the query has texts
    found = failed.groupBy(*key).agg(F.array_sort(F.collect_set("_e")).alias("_found"), F.max("_l").alias("_worst"))
    rows = lookup(df, found, key)
    return rows.withColumns(
        {
            "errors": F.concat("errors", F.coalesce("_found", F.array().cast(f"array<{ERROR}>"))),
            "_level": F.greatest("_level", F.coalesce("_worst", F.lit(0))),
        }
    ).select(*df.columns)


def gate(
    df: DataFrame,
    rules: Sequence[Rule],
    key: Sequence[str],
    file: str = "",
    formats: Sequence[LocalFormat] = (),
    views: Mapping[str, DataFrame] | None = None,
    previous: DataFrame | None = None,
) -> GateResult:
    """[Q02, Q04 to Q17, Q21] Tag every row with its errors and grade.

    `tagged` is the input plus `errors` (array of structs) and `grade` (ok, low, medium, high). Order:
    missing-value tokens, date rewriting, duplicates, all column rules in one projection, then queries.
    Without rules every row passes unchanged. A rule that names an unknown column is an error: it must
    not let data pass unchecked. `key` names the columns that should identify a row; nothing rests on it
    doing so: every input row comes out once, whatever repeats.
    """
    columns = list(df.columns)
    empty = F.array().cast(f"array<{ERROR}>")
    if not rules:
        tagged = df.withColumns({"errors": empty, "grade": F.lit("ok")})
        return GateResult(tagged, (), tuple(columns), tuple(key))
    for rule in rules:
        unknown = [c for c in (*rule.columns, *(rule.items if rule.kind == "duplicate" else ())) if c not in columns]
        if unknown:
            raise ValueError(f"rule {rule.name} names unknown columns {unknown}")
    data = project.null_tokens(df)
    for rule in rules:
        if rule.kind == "date":
            data = normalise_dates(data, rule.columns, str(rule.arg), formats, file)
    flags = {i: f"_dup{i}" for i, rule in enumerate(rules) if rule.kind == "duplicate"}
    if flags:
        # written once: the counts read a few columns of it, and the rows are not worked out again for each
        if any(not rules[i].items for i in flags):
            data = data.withColumns({ROW: F.monotonically_increasing_id(), FINGERPRINT: fingerprint([c for c in columns if c not in key])})
        data = materialise(data, "normalised")
    for i, name in flags.items():
        data = _mark_duplicates(data, rules[i], name, key)
    checked = [
        (i, rule, column)
        for i, rule in enumerate(rules)
        if rule.kind not in ("custom", "history")
        for column in rule.columns
    ]
    # One projection says what fails; the next builds errors and level from those flags alone.
    failed = data.select(
        *columns, *[(~checks.passes(r, c, flags.get(i))).alias(f"_f{n}") for n, (i, r, c) in enumerate(checked)]
    )
    found = [
        F.when(F.col(f"_f{n}"), F.array(_error(i, r, c, r.message(c), r.priority)).cast(f"array<{ERROR}>")).otherwise(empty)
        for n, (i, r, c) in enumerate(checked)
    ]
    levels = [
        F.when(F.col(f"_f{n}"), F.lit(LEVELS.index(grade_of(r.priority)))).otherwise(0)
        for n, (_, r, _) in enumerate(checked)
    ]
    data = failed.select(
        *columns,
        (F.concat(*found) if found else empty).alias("errors"),
        F.greatest(F.lit(0), F.lit(0), *levels).alias("_level"),
    )
    for i, rule in enumerate(rules):
        if rule.kind == "custom":
            data = _run_query(data, i, rule, views or {}, key)
        elif rule.kind == "history":
            data = _run_query(data, i, rule, {**(views or {}), "previous": previous}, key)
    grade = F.element_at(F.array(*[F.lit(v) for v in LEVELS]), F.col("_level") + 1)
    return GateResult(data.withColumn("grade", grade).drop("_level"), tuple(rules), tuple(columns), tuple(key))


def previous_snapshot(snapshots: DataFrame, run_column: str, today: dt.date) -> DataFrame:
    """[Q11] The rows of the last run before today."""
    past = snapshots.filter(F.to_date(F.col(run_column)) < F.lit(today))
    last = past.agg(F.max(run_column)).first()[0]
    return past.filter(F.col(run_column) == F.lit(last))


def post_load(
    spark,
    rules: Sequence[Mapping[str, str]],
    region: str,
    excluded: Sequence[str] = (),
    views: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """[Q31] Results of the active post-load rules of a region, by target table and name.

    A rule has name, query, region, active flag and target; excluded names come from the control table. Queries name the
    frames of `views` in braces, so two runs in one session do not meet.
    """
    return {
        f"{r['target']}.{r['name']}": spark.sql(r["query"], **(views or {}))
        for r in rules
        if r["active"] == "A" and r["region"] == region and r["name"] not in excluded
    }
