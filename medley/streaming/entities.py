"""Raw entities loaded from their landing folders as one stream, each key once, with keyed state that a timer clears."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from medley.operators.load import overwrite_partitions

BUCKETS = 16
CELLS = 256
HELD = 1 << 18
DAY = 86_400_000
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
PLAIN, ROCKS = (f"org.apache.spark.sql.execution.streaming.state.{n}StateStoreProvider" for n in ("HDFSBacked", "RocksDB"))
BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
PLAIN_NAME = re.compile(r"\w+", re.ASCII)
PERIODS = {"day": "1 day", "month": "1 month", "year": "1 year"}
LOADED, LATE, BAD = "loaded", "late", "bad"
ROW = "entity string, event_date date, at timestamp, key string, value string, kind string"
PIECE = 8 << 20
NEVER = -(1 << 31)
GROUP = ["entity", "day", "until", "bucket"]
PACKED = "entity string, day int, until int, bucket int, rows binary"
KEPT = "entity string, day int, kind string, rows binary"
WIDE = "entity string, day int, kind string, key string, value string, at_us long"
INNER = pa.schema([("key", pa.string()), ("value", pa.string()), ("at_us", pa.int64()), ("cell", pa.int32())])


@dataclass(frozen=True)
class Entity:
    """One kind of record: the folder it lands in, the JSON fields of its key and the one of its event time."""

    name: str
    key: Sequence[str]
    at: str


def read_landing(spark: SparkSession, path: str, entities: Sequence[Entity], files: int = 200) -> DataFrame:
    """[R01] New lines of JSON under `<path>/entity=<name>/` as a stream: entity, key, at and value, the line as it came.

    One parse gives all fields of a line, but of two with one name the last, where `get_json_object` gives the first: so it is
    taken for lines that hold each name once, and nothing that may hide a name (an escape, a single quote).
    """
    lines = spark.readStream.schema("value string, entity string").option("maxFilesPerTrigger", files).text(path)

    def of(pick: Any) -> Column:
        return reduce(lambda rest, e: F.when(F.col("entity") == e.name, pick(e)).otherwise(rest), entities, F.lit(None))

    most = range(1 + max(len(e.key) for e in entities))
    value, name = F.col("value"), lambda i: F.col(f"n{i}")
    named = lines.select(
        "entity", "value", of(lambda e: F.lit(len(e.key))).alias("keys"), of(lambda e: F.lit(all(map(PLAIN_NAME.fullmatch, [e.at, *e.key])))).alias("flat"),
        *[F.coalesce(of(lambda e, i=i: F.lit([e.at, *e.key][i]) if i <= len(e.key) else F.lit("")), F.lit("")).alias(f"n{i}") for i in most],
    )
    quoted = [F.concat(F.lit('"'), name(i), F.lit('"')) for i in most]
    once = [(name(i) == "") | (F.octet_length("value") - F.octet_length(F.replace(value, q, F.lit(""))) <= F.octet_length(q)) for i, q in zip(most, quoted, strict=True)]
    hidden = F.contains(value, F.lit("\\")) | F.contains(value, F.lit("'"))
    found = F.call_function("json_tuple", value, *[name(i) for i in most]).alias(*[f"t{i}" for i in most])
    parsed = named.select("*", reduce(lambda a, b: a & b, once, F.col("flat") & ~hidden).alias("plain"), found)
    field = lambda i: F.when(F.col("plain"), F.col(f"t{i}")).otherwise(F.call_function("get_json_object", value, F.concat(F.lit("$."), name(i))))
    rows = parsed.select("entity", "value", "keys", *[field(i).alias(f"f{i}") for i in most])
    key = F.lit(None)
    for n in sorted({len(e.key) for e in entities}):
        own = [F.col(f"f{i}") for i in range(1, n + 1)]
        key = F.when((F.col("keys") == n) & reduce(lambda a, b: a & b, [f.isNotNull() for f in own]), F.to_json(F.array(*own))).otherwise(key)
    return rows.select("entity", key.alias("key"), F.try_to_timestamp("f0").alias("at"), "value")


class Once(StatefulProcessor):
    """The first row of each key of one entity, period and bucket; rows behind the watermark are marked as late.

    Keys are held in a map of their group, dealt over cells, so that a call to the state reads or writes a cell and not a
    key; what a micro-batch costs follows from its own rows and the cells they fall into. One timer clears the map when the
    watermark has left the period: from then on every row of the period is late, whether its key was there or not.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "cell int", "keys array<string>")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        filled, fresh = self.seen.exists(), False
        held: dict[int, set[str]] = {}
        added: set[int] = set()
        for batch in rows:
            late = batch.at_ms < watermark
            new = batch[~late].drop_duplicates("key")
            cells, keys = new.cell.tolist(), new.key.tolist()
            for c in set(cells) - held.keys():
                held[c] = set(self.seen.getValue((c,))[0]) if filled and self.seen.containsKey((c,)) else set()
            new = new[np.array([k not in held[c] for c, k in zip(cells, keys, strict=True)], bool)]
            cells, keys = new.cell.tolist(), new.key.tolist()
            for c, k in zip(cells, keys, strict=True):
                held[c].add(k)
            added.update(cells)
            fresh |= len(new) > 0
            if sum(map(len, held.values())) > HELD:
                self.keep(held, added)
                filled, held, added = True, {}, set()
            yield pd.concat([new.assign(kind=LOADED), batch[late].assign(kind=LATE)])[["entity", "day", "key", "at_us", "value", "kind"]]
        self.keep(held, added)
        if fresh:
            self.handle.registerTimer(int(key[2]) * DAY)

    def keep(self, held: dict[int, set[str]], added: set[int]) -> None:
        """Write the cells that have got keys."""
        for c in added:
            self.seen.updateValue((c,), (list(held[c]),))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together to some MB."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= PIECE:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a group in one row, a piece of the input at a time, in the order in which they came."""
    for piece in pieces(batches):
        codes = [piece[c].dictionary_encode(null_encoding="encode") for c in GROUP]
        codes = [c.indices.to_numpy().astype(np.int16 if len(c.dictionary) < 1 << 15 else np.int32) for c in codes]
        order = np.lexsort(codes[::-1])
        starts = np.flatnonzero(np.r_[True, reduce(np.logical_or, [np.diff(c[order]) != 0 for c in codes])][: len(order)])
        rows = piece.select(INNER.names).take(order).cast(INNER)
        packed = [rows.slice(a, b - a).serialize().to_pybytes() for a, b in zip(starts, [*starts[1:], len(order)], strict=True)]
        yield pa.record_batch([*piece.select(GROUP).take(order[starts]).columns, pa.array(packed, pa.binary())], [*GROUP, "rows"])


def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed rows one by one again."""
    for batch in batches:
        for at in range(len(batch)):
            rows = pa.ipc.read_record_batch(batch["rows"][at].as_buffer(), INNER)
            names = ["entity", "day", "kind"]
            yield pa.record_batch([*[pa.repeat(batch[c][at], len(rows)) for c in names], rows["key"], rows["value"], rows["at_us"]], [*names, "key", "value", "at_us"])


class Packed(Once):
    """`Once` over the rows of a group that come packed and leave packed.

    Spark hands a state its rows one by one, as Python tuples, which costs more than all that is done with them; a packed
    row carries hundreds or thousands. Payloads stay in Arrow's form, and a text becomes a Python object for no other column than the key.
    Rows that no state can hold, without a key or a time, are passed on.
    """

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        given = pieces(pa.ipc.read_record_batch(pa.py_buffer(r), INNER) for frame in rows for r in frame["rows"])
        if key[2] == NEVER:
            for piece in given:
                yield self.packed(key, BAD, piece)
            return
        at_hand: list[pa.RecordBatch] = []

        def frames() -> Iterator[pd.DataFrame]:
            for piece in given:
                at_hand[:] = [piece]
                at = piece["at_us"].to_numpy()
                columns = {"key": piece["key"].to_numpy(zero_copy_only=False), "at_us": at, "at_ms": at // 1000, "cell": piece["cell"].to_numpy()}
                yield pd.DataFrame({"entity": key[0], "day": key[1], **columns, "value": np.arange(len(at))})

        for out in super().handleInputRows(key, frames(), timerValues):
            for kind, number in out.groupby("kind")["value"]:
                yield self.packed(key, kind, at_hand[0] if len(number) == len(at_hand[0]) else at_hand[0].take(number.to_numpy()))

    def packed(self, key: Any, kind: str, rows: pa.RecordBatch) -> pd.DataFrame:
        return pd.DataFrame({"entity": [key[0]], "day": [key[1]], "kind": [kind], "rows": [rows.serialize().to_pybytes()]})


def started(query: DataStreamWriter, spark: SparkSession) -> StreamingQuery:
    """Start a query whose state needs column families, which Spark's default store has not, and whose rows are large.

    A query takes the session's settings when it starts, so the store and the size of what goes to Python at once are named for
    that moment only; a store that the user has chosen stays.
    """
    before = {k: spark.conf.get(k) for k in (PROVIDER, BYTES)}
    own = {PROVIDER: ROCKS if before[PROVIDER] == PLAIN else before[PROVIDER], BYTES: f"{PIECE}b"}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        return query.start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def load_entities(
    stream: DataFrame, path: str, checkpoint: str, delay: str = "2 days", period: str = "day", buckets: int = BUCKETS
) -> StreamingQuery:
    """[R01, R02] All entities into `path`, partitioned by kind, entity and first day of the period: each key of a period once.

    What a micro-batch costs follows from its own rows and the keys of the periods that the watermark has not left; the table
    is never read. Keys of one entity and period are dealt over `buckets` states. Rows behind the watermark go to kind
    ``late``, lines without a key or a time to kind ``bad``: nothing is lost. A batch that runs again overwrites its own folder.
    """
    timed = stream.withWatermark("at", delay)
    # plain numbers do not carry the watermark on, so late rows reach the state's function and are not dropped before it
    first = F.date_trunc(period, F.timestamp_micros(F.unix_micros("at"))).cast("date")
    usable = F.col("key").isNotNull() & F.col("at_us").isNotNull()
    rows = timed.select("entity", "key", "value", F.unix_micros("at").alias("at_us"), first.alias("first")).select(
        "entity", "key", "value", "at_us", F.coalesce(F.unix_date("first"), F.lit(NEVER)).alias("day"),
        F.when(usable, F.unix_date((F.col("first") + F.expr(f"INTERVAL {PERIODS[period]}")).cast("date"))).otherwise(NEVER).alias("until"),
        F.pmod(F.xxhash64("entity", F.when(usable, F.col("key")).otherwise(F.col("value"))), F.lit(buckets)).cast("int").alias("bucket"),
        F.pmod(F.hash("key"), F.lit(CELLS)).alias("cell"),
    )
    packed = rows.mapInArrow(pack, PACKED)
    kept = packed.groupBy(*GROUP).transformWithStateInPandas(Packed(), KEPT, "Append", "EventTime")

    def write(batch: DataFrame, number: int) -> None:
        own = f"{batch.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}-{number:010d}"
        day = F.date_from_unix_date(F.nullif("day", F.lit(NEVER)))
        out = batch.mapInArrow(unpack, WIDE).select("entity", day.alias("event_date"), "key", F.timestamp_micros("at_us").alias("at"), "value", "kind")
        overwrite_partitions(out.withColumn("batch", F.lit(own)), path, ["batch", "kind", "entity", "event_date"])

    query = kept.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return started(query.trigger(availableNow=True), stream.sparkSession)


def read_loaded(spark: SparkSession, path: str, kind: str = LOADED) -> DataFrame:
    """[R01] The rows of one kind."""
    rows = spark.read.schema(f"{ROW}, batch string").parquet(path).filter(F.col("kind") == kind)
    return rows.select("entity", "event_date", "key", "at", "value")


def with_late(spark: SparkSession, path: str) -> DataFrame:
    """[R02] Loaded rows and the late ones whose key their date does not have yet, the earliest of each.

    The late rows' keys travel to the loaded ones' side; no payload does.
    """
    loaded, late = read_loaded(spark, path), read_loaded(spark, path, LATE)
    keys = ["entity", "event_date", "key"]
    first = late.groupBy(*keys).agg(F.min(F.struct("at", "value")).alias("row")).select(*keys, "row.*")
    return loaded.unionByName(first.join(loaded.select(*keys), keys, "left_anti"))
