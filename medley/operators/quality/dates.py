"""Date columns brought to the expected pattern before they are checked."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medley.functions import dates, text
from medley.operators.quality.rules import local_format_applies


@dataclass(frozen=True)
class LocalFormat:
    """One row of the local date format table."""

    pattern: str
    with_time: bool = False
    active: str = "A"
    file_pattern: str = "*"


def normalise_dates(
    df: DataFrame, columns: Sequence[str], expected: str, formats: Sequence[LocalFormat] = (), file: str = ""
) -> DataFrame:
    """[Q13, Q14, Q15, Q16] Rewrite local date texts to the expected pattern, then unify separators.

    Formats are tried in table order, each on the result of the one before; separators come last, and that
    order changes results. All columns are done in one projection. Only texts are rewritten; a column that is a date or a
    time already stays one.
    """
    done = {}
    for name in columns:
        if df.schema[name].dataType.typeName() != "string":
            continue
        col = F.col(f"`{name}`")
        for fmt in formats:
            if local_format_applies(fmt.active, fmt.file_pattern, file):
                col = dates.rewrite(col, expected, fmt.pattern, fmt.with_time)
        done[name] = text.unify_separators(col, expected)
    return df.withColumns(done) if done else df
