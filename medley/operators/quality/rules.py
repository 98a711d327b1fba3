"""Rules: what they hold and which of them apply to a file."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rule names as delivered in the rule table, and the kind of check behind each.
KINDS = {
    "null_check": "mandatory",
    "mandatory_check": "mandatory",
    "numeric_check": "numeric",
    "date_check": "date",
    "valid_value_check": "valid_value",
    "duplicate_check": "duplicate",
    "custom_check": "custom",
    "df_custom_check": "expr",
    "history_check": "history",
}

MAX_RULES = 10_000


@dataclass(frozen=True)
class Rule:
    """One rule. A predicate states when a value passes; null counts as a failure.

    `arg` depends on the kind: a date pattern (date), the allowed values (valid_value, comma list or
    sequence), the key columns (duplicate, comma list; empty for the whole row), an SQL expression with
    `{col}` (expr), or a query over `{data}` and, for history, `{previous}`.
    """

    name: str
    kind: str
    columns: tuple[str, ...]
    subject: str
    priority: str = "low"
    mail_group: str = ""
    arg: str | Sequence[str] | None = None

    @property
    def items(self) -> list[str]:
        """The argument as a list."""
        if self.arg is None:
            return []
        if isinstance(self.arg, str):
            return [a.strip() for a in self.arg.split(",") if a.strip()]
        return list(self.arg)

    def message(self, column: str) -> str:
        """The subject, followed by the column unless the subject already has a colon."""
        return self.subject if ":" in self.subject else f"{self.subject}: {column}"


def select_rules(rules: DataFrame, country: str, source: str, file: str, file_format: str) -> DataFrame:
    """[Q01] Active rules for a file, all comparisons without regard to case.

    The rule's country text contains the country, the source is equal, the file name matches the rule's
    pattern and the file format matches the rule's `*` pattern.
    """
    plain = F.lit(file_format.upper().replace("*", ""))
    pattern = F.concat(F.replace(F.upper("config_filename_format"), F.lit("*"), F.lit("%")), F.lit("%"))
    return rules.filter(
        F.contains(F.upper("country_code"), F.lit(country.upper()))
        & (F.upper("source_system") == source.upper())
        & F.like(F.lit(file.upper()), F.upper("file_name"))
        & (F.upper("active_flag") == "A")
        & F.like(plain, pattern)
    )


def to_rules(rules: DataFrame) -> list[Rule]:
    """Rule rows as objects. Structure checks are left out: they need no data (see `structure_check`)."""
    rows = rules.filter("rule_name IS NULL OR rule_name <> 'structure_check'").limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules for one file")
    unknown = sorted({str(r["rule_name"]) for r in rows if (r["rule_name"] or "").lower() not in KINDS})
    if unknown:
        raise ValueError(f"unknown rules {unknown}: data must not pass unchecked")
    return [
        Rule(
            name=r["rule_name"],
            kind=KINDS[r["rule_name"].lower()],
            columns=tuple(c.strip() for c in (r["column_name"] or "").split(",") if c.strip()),
            subject=r["subject_line"],
            priority=r["priority_level"],
            mail_group=r["mail_group"] or "",
            arg=r["sql_query"],
        )
        for r in rows
    ]


def structure_check(columns: Sequence[str], expected: Sequence[str], ignore_case: bool = False) -> bool:
    """[Q03] Same columns in the same order; case counts unless the source is one that ignores it."""
    if ignore_case:
        return [c.upper() for c in columns] == [c.upper() for c in expected]
    return list(columns) == list(expected)


def local_format_applies(active: str, pattern: str, file: str) -> bool:
    """[Q15] A local date format applies if active and its file pattern is `*` or part of the file name."""
    return active == "A" and (pattern == "*" or pattern.upper() in file.upper())
