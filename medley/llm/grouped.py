"""Batches cut into bounded parts, or between groups of sorted rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T


PART = 1 << 22
BATCH_SETTING, BATCH_DEFAULT, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m"


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with batches that stay small however long the rows are.

    Spark's default allows 64 MB a batch, which both sides hold several times over; the session's setting is lowered to
    8 MB unless the user has chosen one.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, BATCH_DEFAULT) == BATCH_DEFAULT:
        conf.set(BATCH_SETTING, BATCH)
    return df.mapInArrow(run, schema)


def parts(batches: Iterator[pa.RecordBatch], limit: int = PART) -> Iterator[pa.RecordBatch]:
    """The rows again in batches of about ``limit`` bytes, one row at least, so that what is made of one stays small."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * min(1.0, limit / max(1, batch.nbytes))))
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows again, cut only between groups of equal keys; rows come sorted by them, so memory is bounded by a group."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([rest, rows]) if rest is not None else rows
        last = np.ones(rows.num_rows, bool)
        for k in keys:
            column = rows.column(k).to_numpy()
            last &= column == column[-1]
        cut = 0 if last.all() else rows.num_rows - int(np.argmin(last[::-1]))
        if cut:
            yield rows.slice(0, cut)
        rest = rows.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest
