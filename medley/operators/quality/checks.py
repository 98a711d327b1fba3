"""Pass predicates, one per kind of check. A null value passes every check but the mandatory one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from medley.functions.dates import parse_date
from medley.operators.quality.rules import Rule


def mandatory(col: Column) -> Column:
    """[Q05] Ours: a value is there, and a text is not blank."""
    return col.isNotNull() & (F.trim(col.cast("string")) != "")


def numeric(col: Column) -> Column:
    """[Q06] Ours: the text reads as a number."""
    return col.isNull() | col.cast("string").try_cast("double").isNotNull()


def date(col: Column, pattern: str) -> Column:
    """[Q07] Ours: the text reads as a date by the expected pattern."""
    return col.isNull() | parse_date(col.cast("string"), pattern).isNotNull()


def valid_value(col: Column, allowed: list[str]) -> Column:
    """[Q08] Ours: the value is among the allowed ones."""
    return col.isNull() | col.cast("string").isin(*allowed)


def expression(rule: Rule, column: str) -> Column:
    """[Q12] An SQL expression with `{col}` in place of the column. Never Python text."""
    return F.expr(str(rule.arg).replace("{col}", f"`{column}`"))


def passes(rule: Rule, column: str, duplicate: str | None = None) -> Column:
    """The pass predicate of a rule for one column; unknown outcomes are failures."""
    col = F.col(f"`{column}`") if column else None
    if rule.kind == "mandatory":
        found = mandatory(col)
    elif rule.kind == "numeric":
        found = numeric(col)
    elif rule.kind == "date":
        found = date(col, str(rule.arg))
    elif rule.kind == "valid_value":
        found = valid_value(col, rule.items)
    elif rule.kind == "expr":
        found = expression(rule, column)
    elif rule.kind == "duplicate":
        found = ~F.col(duplicate)
    else:
        raise ValueError(f"no column predicate for kind {rule.kind!r}")
    return F.coalesce(found, F.lit(False))
