"""Text expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that stands for a missing value in delivered files.
NULL_TOKENS = ("NaN", "nan", "None", "none")

# The ASCII letters, for swapping case.
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def null_token(col: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """[P13] Null where the text is a token for a missing value."""
    return F.when(~col.isin(*tokens), col)


def swap_case(col: Column) -> Column:
    """[X01] Upper to lower and lower to upper, ASCII letters only."""
    return F.translate(col, LOWER + UPPER, UPPER + LOWER)


def part(col: Column, delimiter: str, index: int, limit: int = -1) -> Column:
    """[X03] The index-th piece (from 0) of a text cut at a literal delimiter; null past the end."""
    return F.get(F.split(col, "\\Q" + delimiter + "\\E", limit), index)


def pieces(col: Column, delimiter: str) -> Column:
    """[X20] Trimmed pieces of a delimited text, ready to explode."""
    return F.transform(F.split(col, "\\Q" + delimiter + "\\E"), lambda p: F.trim(p))


def drop_lead(col: Column, n: int) -> Column:
    """[X04] The text without its first n characters."""
    return F.substring(col, n + 1, 2147483647)


def unify_separators(col: Column, expected: str) -> Column:
    """[Q16] Replace date separators by the one used in the expected pattern.

    The separator is the first of . - / , that occurs in the pattern; no separator, no change.
    """
    found = next((s for s in (".", "-", "/", ",") if s in expected), None)
    return col if found is None else F.regexp_replace(col, "[./,-]", found)


def like_pattern(pattern: str) -> str:
    """[P17] A file pattern (* for any run of characters) as an upper-case LIKE pattern."""
    return pattern.upper().replace("*", "%")


def contains(hay: Column, needle: Column | str) -> Column:
    """[X27] True if the needle occurs in the text."""
    return F.contains(hay, needle if isinstance(needle, Column) else F.lit(needle))


def priority_level(col: Column) -> Column:
    """[X28, Q21] Grade of a priority text: high over medium over low; ok if it is null."""
    up = F.upper(col)
    return (
        F.when(col.isNull(), "ok")
        .when(F.contains(up, F.lit("HIGH")), "high")
        .when(F.contains(up, F.lit("MEDIUM")), "medium")
        .otherwise("low")
    )


def error_report(line: Column, marker: str) -> tuple[Column, Column]:
    """[C06] URL and message of an error line `<url>...<marker> <message>`.

    The URL runs up to and including the marker; the message is the rest, left-trimmed.
    """
    url = F.concat(F.ltrim(part(line, marker, 0, 2)), F.lit(marker))
    return url, F.ltrim(part(line, marker, 1, 2))


def stable_hash(col: Column, salt: str = "") -> Column:
    """[X18, K07] SHA-256 of the trimmed lower-case text, salted; null stays null."""
    return F.sha2(F.concat(F.lit(salt), F.lower(F.trim(col))), 256)


def ordinal(col: Column, order: Sequence[str]) -> Column:
    """[X24] Position (from 0) of a category in its order; unknown or null gives null."""
    pos = F.array_position(F.array(*[F.lit(o) for o in order]), col)
    return F.when(pos > 0, (pos - 1).cast("int"))


def quoted_number(col: Column) -> Column:
    """[H06] Scraped text as a number: thousands commas and blanks dropped, null if not a number."""
    return F.regexp_replace(F.trim(col), "[, ]", "").try_cast("double")
