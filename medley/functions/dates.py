"""Date and time expressions. The run date is always a parameter."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _shape(pattern: str) -> str | None:
    """A regular expression that every text of an all-digit pattern fits; None for other patterns."""
    digits = {"yyyy": r"\d{4}", **{c * 2: r"\d{2}" for c in "MdHms"}, **{c: r"\d{1,2}" for c in "MdHms"}}
    out = ""
    for token in _tokens(pattern):
        if token[0].isalpha():
            if token not in digits:
                return None
            out += digits[token]
        else:
            out += re.escape(token.strip("'") if token.startswith("'") else token)
    return f"^{out}$"


def _tokens(pattern: str) -> list[str]:
    """Runs of one letter, quoted texts and single other characters."""
    return [m.group(0) for m in re.finditer(r"'[^']*'|([a-zA-Z])\1*|[^a-zA-Z']", pattern)]


def _guarded(col: Column, pattern: str, parsed: Column) -> Column:
    """Parse only texts of the right shape: a failed parse costs an exception, a failed match does not."""
    shape = _shape(pattern)
    return parsed if shape is None else F.when(col.rlike(shape), parsed)


def parse_date(col: Column, pattern: str) -> Column:
    """[X07] A date by pattern, null if the text does not fit."""
    return _guarded(col, pattern, F.try_to_date(col, pattern))


def parse_timestamp(col: Column, pattern: str) -> Column:
    """[X07] A timestamp by pattern, null if the text does not fit."""
    return _guarded(col, pattern, F.try_to_timestamp(col, F.lit(pattern)))


def parts(col: Column) -> dict[str, Column]:
    """[X09] Year, month, day of month and quarter."""
    return {"year": F.year(col), "month": F.month(col), "day": F.dayofmonth(col), "quarter": F.quarter(col)}


def day_window(run_date: dt.date, before: int, after: int) -> tuple[Column, Column]:
    """[X10] The days `before` and `after` a run date."""
    day = F.lit(run_date)
    return F.date_sub(day, before), F.date_add(day, after)


def days_later(later: Column, earlier: Column) -> Column:
    """[X11] True if `later` is at least one calendar day after `earlier`."""
    return F.datediff(later, earlier) > 0


def age_years(born: Column, run_date: dt.date) -> Column:
    """[X12] Whole years as days // 365 (leap days are not corrected, as in the source rule)."""
    return F.floor(F.datediff(F.lit(run_date), born) / 365)


def to_utc(col: Column, zone: str) -> Column:
    """[X13] Wall time in a zone as UTC."""
    return F.to_utc_timestamp(col.cast("timestamp"), zone)


def from_utc(col: Column, zone: str) -> Column:
    """[X13] UTC as wall time in a zone."""
    return F.from_utc_timestamp(col.cast("timestamp"), zone)


def region_zone(region: str, zones: Mapping[str, str], default: str = "UTC") -> str:
    """[X13] Time zone of a region by a configured table, `default` where none is listed."""
    return zones.get(region, default)


def elapsed(end: Column, start: Column) -> tuple[Column, Column]:
    """[X14] Elapsed time as an interval, and as whole microseconds for export."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return end - start, micros


def weekday(col: Column) -> Column:
    """[X15] English weekday name."""
    return F.date_format(col, "EEEE")


def is_weekend(col: Column) -> Column:
    """[X15] True on Saturday and Sunday."""
    return F.dayofweek(col).isin(1, 7)


def on_hour(col: Column, every: int) -> Column:
    """[X15] True in hours divisible by `every`."""
    return F.hour(col) % every == 0


def from_parts(text: Column, year: tuple[int, int], month: tuple[int, int], day: tuple[int, int]) -> Column:
    """[X16] A date from (position from 1, length) of year, month and day inside a text."""
    joined = F.concat_ws("-", *[F.substring(text, *at) for at in (year, month, day)])
    return F.try_to_date(joined, "yyyy-MM-dd")


def rewrite(col: Column, expected: str, local: str, with_time: bool = False) -> Column:
    """[Q13, Q14] Rewrite a text from a local pattern to the expected one.

    Only where the expected pattern fails and the local one parses. With a time part, the target is the
    expected date pattern followed by the local time part, joined as in the local pattern (T or blank).
    """
    if not with_time:
        rewritten = F.coalesce(F.date_format(parse_date(col, local), expected), col)
        return F.when(parse_date(col, expected).isNotNull(), col).otherwise(rewritten)
    mark = "'T'" if "'T'" in local else ("T" if "T" in local else " ")
    target = expected + ("'T'" if "T" in mark else " ") + local.split(mark, 1)[1]
    pattern = local if mark != "T" else local.replace("T", "'T'", 1)
    rewritten = F.coalesce(F.date_format(parse_timestamp(col, pattern), target), col)
    return F.when(parse_timestamp(col, expected).isNotNull(), col).otherwise(rewritten)


def scrape_lists(frequency: str | None, day: dt.date, lists: dict[str, Sequence[str]]) -> Sequence[str]:
    """[X15] Which request list applies: all, weekend, weekday (daily runs) or hourly."""
    if not frequency:
        return lists["all"]
    if frequency == "daily":
        return lists["weekend"] if day.weekday() >= 5 else lists["weekday"]
    return lists["hourly"]
