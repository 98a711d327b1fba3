"""Exact repeated word windows by super-k-mer partitioning.

A window is WINDOW consecutive words. Its minimiser is the least hash among its runs of M words; consecutive windows whose
minimiser stands at the same place form a super-k-mer. Equal windows have equal minimisers, so a minimiser that occurs once
holds no repeat: a first pass sends only minimisers, and a second one sends the super-k-mers of those that occur again, each
as one packed string of word hashes, to the minimiser's bucket, where sorting finds every window's earliest place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medley import session
from medley.llm import words
from medley.llm.grouped import mapped, parts, whole_groups

WINDOW = 20
M = 6
BUCKET = 20_000

_C = [words.mix(np.arange(1, 1 + 1024, dtype=np.uint64) * np.uint64(k)) | np.uint64(1) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


def rolled(hashed: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """A hash of every run of ``size`` words."""
    out = np.zeros(max(0, len(hashed) - size + 1), np.uint64)
    for k in range(size):
        out += hashed[k : k + len(out)] * _C[salt][k]
    return words.mix(out)


def super_kmers(hashed: np.ndarray, row: np.ndarray, window: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word (index into ``hashed``), number of windows and minimiser of every super-k-mer."""
    none = np.zeros(0, np.int64)
    if len(hashed) < window:
        return none, none, none, np.zeros(0, np.uint64)
    value = rolled(hashed, m)
    n, span = len(hashed) - window + 1, window - m + 1
    least, place = value[:n].copy(), np.zeros(n, np.int64)
    for k in range(1, span):
        np.minimum(least, value[k : k + n], out=least)
    for k in range(span - 1, -1, -1):
        place[value[k : k + n] == least] = k
    place += np.arange(n)
    own = np.flatnonzero(row[:n] == row[window - 1 :])
    if not len(own):
        return none, none, none, np.zeros(0, np.uint64)
    new = np.ones(len(own), bool)
    new[1:] = (place[own[1:]] != place[own[:-1]]) | (row[own[1:]] != row[own[:-1]]) | (own[1:] != own[:-1] + 1)
    head = np.flatnonzero(new)
    return row[own[head]], own[head], np.diff(np.append(head, len(own))), least[own[head]]


def _hashed(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For pieces of the column: first and last row, row (in the piece) and hash of every word."""
    data, offsets = words.buffers(column)
    for low, high in words.slices(offsets):
        part, own = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        row, start, end = words.spans(part, own)
        yield low, high, row, words.hashes(part, start, end)


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of every document and a digest of their sequence."""
    for batch in parts(batches):
        count, digest = [], []
        for low, high, row, hashed in _hashed(batch.column(1)):
            ends = np.searchsorted(row, np.arange(low, high) - low, "right")
            for a, b in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True):
                count.append(b - a)
                digest.append(hashlib.blake2b(hashed[a:b].tobytes(), digest_size=16).digest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count, pa.int64()), pa.array(digest, pa.binary())], ["doc_id", "n_words", "digest"])


def _minimisers(window: int, m: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Every super-k-mer without its words; ``sequence`` tells documents of different words apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for low, high, row, hashed in _hashed(batch.column(1)):
                of, first, n, least = super_kmers(hashed, row, window, m)
                if not len(of):
                    continue
                begin = np.searchsorted(row, np.arange(high - low))
                ends = np.searchsorted(row, np.arange(high - low), "right")
                place = np.arange(len(hashed), dtype=np.uint64) - begin[row].astype(np.uint64)
                sums = np.concatenate([[np.uint64(0)], np.cumsum(words.mix(hashed + place * _C[0][0]))])
                sequence = words.mix(sums[ends] - sums[begin])
                order = np.lexsort((least, of))
                again = (of[order][1:] == of[order][:-1]) & (least[order][1:] == least[order][:-1])
                twice = np.zeros(len(of), bool)
                twice[order[1:]] |= again
                columns = [least.view(np.int64), ids[low + of], first - begin[of], n, sequence[of].view(np.int64), twice]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c).cast(k) for c, k in zip(columns, kinds, strict=True)], ["mini", "doc_id", "start", "n", "sequence", "twice"]
                )

    return run


def _packed(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The super-k-mers named in ``hits`` with their words as one packed string, and the part of the bucket that they go to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            ids, hits = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2)
            for low, high, row, hashed in _hashed(batch.column(1)):
                begin = np.searchsorted(row, np.arange(high - low))
                ends = np.searchsorted(row, np.arange(high - low), "right")
                own = hits.slice(low, high - low)
                size = np.diff(own.offsets.to_numpy())
                flat = own.flatten()
                mini, start, n, share = (flat.field(c).to_numpy() for c in ("mini", "start", "n", "parts"))
                of = np.repeat(np.arange(high - low), size)
                stop = begin[of] + start + n + window - 1
                ok = stop <= ends[of]
                mini, start, n, share, of, stop = (x[ok] for x in (mini, start, n, share, of, stop))
                doc = ids[low + of]
                salt = words.mix(doc.astype(np.uint64) * _C[0][0] + start.astype(np.uint64) * _C[1][0]) % share.astype(np.uint64)
                offsets = np.concatenate([[0], np.cumsum(stop - begin[of] - start)])
                at = np.arange(offsets[-1]) + np.repeat(begin[of] + start - offsets[:-1], np.diff(offsets))
                packed = pa.Array.from_buffers(
                    pa.large_binary(), len(of), [None, pa.py_buffer((offsets * 8).astype(np.int64)), pa.py_buffer(hashed[at])]
                ).cast(pa.binary())
                columns = [mini, salt.astype(np.int32), doc, start.astype(np.int32), share.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), packed], ["mini", "salt", "doc_id", "start", "parts", "words"])

    return run


def _repeats(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of whole parts of buckets: runs of windows that start earlier in the part; the earliest windows of parted buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["mini", "salt"]):
            doc, start, share = (rows.column(c).to_numpy() for c in ("doc_id", "start", "parts"))
            key, salt = rows.column("mini").to_numpy(), rows.column("salt").to_numpy()
            packed = rows.column("words").to_pylist()
            size = np.array([len(p) // 8 for p in packed])
            flat = np.frombuffer(b"".join(packed), np.uint64)
            n = size - window + 1
            of = np.repeat(np.arange(len(n)), n)
            local = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            at = np.repeat(np.cumsum(size) - size, n) + local
            one, two = rolled(flat, window)[at], rolled(flat, window, 1)[at]
            place = start[of] + local
            order = np.lexsort((place, doc[of], two, one, salt[of], key[of]))
            a, b = order[:-1], order[1:]
            same = (one[a] == one[b]) & (two[a] == two[b]) & (key[of[a]] == key[of[b]]) & (salt[of[a]] == salt[of[b]])
            # repeated rows of one document put the same window in the same place twice: that is no repeat
            run_head = np.concatenate([[0], np.cumsum(~same)])
            heads = order[np.concatenate([[0], np.flatnonzero(~same) + 1])][run_head]
            late = np.zeros(len(of), bool)
            late[order] = (doc[of[heads]] != doc[of[order]]) | (place[heads] != place[order])
            spot = np.flatnonzero(late)
            new = np.ones(len(spot), bool)
            new[1:] = (spot[1:] != spot[:-1] + 1) | (of[spot[1:]] != of[spot[:-1]])
            first = spot[new]
            length = np.diff(np.append(np.flatnonzero(new), len(spot)))
            yield _rows(doc[of[first]], place[first], length, None, None)
            early = np.flatnonzero(~late & (share[of] > 1))
            if len(early):
                yield _rows(doc[of[early]], place[early], np.ones(len(early), np.int64), one[early].view(np.int64), two[early].view(np.int64))

    return run


def _rows(doc: np.ndarray, start: np.ndarray, n: np.ndarray, one: np.ndarray | None, two: np.ndarray | None) -> pa.RecordBatch:
    prints = [pa.nulls(len(doc), pa.int64()) if x is None else pa.array(x) for x in (one, two)]
    return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(start, pa.int32()), pa.array(n, pa.int32()), *prints], ["doc_id", "start", "n", "one", "two"])


def _cut(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The kept words of every document joined by one space, the number of all and of removed words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            total, removed, kept = [], [], []
            for text, whole, runs in zip(batch.column(0).field("text"), batch.column(1).to_pylist(), batch.column(2), strict=True):
                found = (text.as_py() or "").encode().split()
                gone = np.zeros(len(found), bool)
                if whole:
                    gone[:] = True
                elif runs.is_valid:
                    step = np.zeros(len(found) + 1, np.int64)
                    start, n = (runs.values.field(c).to_numpy() for c in ("start", "n"))
                    ok = start < len(found)
                    np.add.at(step, start[ok], 1)
                    np.add.at(step, np.minimum(start[ok] + n[ok] + window - 1, len(found)), -1)
                    gone = np.cumsum(step[:-1]) > 0
                total.append(len(found))
                removed.append(int(gone.sum()))
                kept.append(b" ".join([w for w, g in zip(found, gone.tolist(), strict=True) if not g] if removed[-1] else found))
            found = [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *found], ["_row", "n_words", "n_removed", "kept_text"])

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, m: int = M) -> DataFrame:
    """Every row with n_words, n_removed and kept_text (the kept words joined by one space); such input columns are replaced.

    A word is a run of bytes other than space and 0x09-0x0D, taken as it is. A word goes if a window of ``window`` words
    covers it whose sequence also starts earlier: in a document of smaller id, or earlier in the same one. Windows are
    judged on the input. A null text has no words, and a text shorter than a window loses none. Rows with a null id come
    after all, are left whole, and their windows do not count. Rows that repeat an id and its text are one document: each
    loses what the other loses, and neither repeats the other.

    Documents of equal words are found by digest first: all but the least id of them lose every word, and take no part in
    the rest. A bucket of more than BUCKET super-k-mers is split by hash; the earliest windows of its parts then meet once
    more by their own hash. Equality is that of 64-bit word hashes, 20 in a row.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    some = rows.where("doc_id IS NOT NULL")
    summary = session.materialise(mapped(some, _summary, "doc_id long, n_words long, digest binary"), "summary")
    first = summary.where(F.col("n_words") >= window).groupBy("digest").agg(F.min("doc_id").alias("least"))
    copies = summary.join(first, "digest").where("doc_id <> least").select("doc_id").distinct()
    light = mapped(some, _minimisers(window, m), "mini long, doc_id long, start int, n int, sequence long, twice boolean")
    found = [F.min("sequence").alias("low"), F.max("sequence").alias("high"), F.max("twice").alias("twice"), F.count("*").alias("freq")]
    again = light.groupBy("mini").agg(*found)
    again = again.where("low <> high OR twice").select("mini", F.ceil(F.col("freq") / BUCKET).cast("int").alias("parts"))
    again = session.materialise(again, "again")  # read from a table, a frequent minimiser's side of the join can be split
    hits = light.drop("sequence", "twice").join(again, "mini").join(copies, "doc_id", "left_anti")
    hits = session.materialise(hits.groupBy("doc_id").agg(F.collect_set(F.struct("mini", "start", "n", "parts")).alias("hits")), "hits")
    packed = mapped(
        some.join(hits, "doc_id", "left").where("hits IS NOT NULL"), _packed(window), "mini long, salt int, doc_id long, start int, parts int, words binary"
    )
    bucket = packed.repartition("mini", "salt").sortWithinPartitions("mini", "salt")
    found = session.materialise(mapped(bucket, _repeats(window), "doc_id long, start int, n int, one long, two long"), "repeats")
    early = found.where("one IS NOT NULL")
    heads = early.groupBy("one", "two").agg(F.min(F.struct("doc_id", "start")).alias("head"))
    late = early.join(heads, ["one", "two"]).where(F.struct("doc_id", "start") != F.col("head")).select("doc_id", "start", "n")
    runs = found.where("one IS NULL").select("doc_id", "start", "n").unionByName(late)
    runs = runs.groupBy("doc_id").agg(F.collect_set(F.struct("start", "n")).alias("runs")).withColumn("whole", F.lit(False))
    runs = runs.unionByName(copies.select("doc_id", F.lit(None).cast(runs.schema["runs"].dataType).alias("runs"), F.lit(True).alias("whole")))
    # the row travels as one struct, so that no column of it can clash
    keep = docs.select(F.struct(*[c for c in docs.columns if c.lower() not in ("n_words", "n_removed", "kept_text")]).alias("_row"))
    own = F.col("_row.doc_id").cast("long")
    judged = keep.where(own.isNotNull()).join(runs, own == F.col("doc_id"), "left").select("_row", "whole", "runs")
    none = keep.where(own.isNull()).withColumns({"whole": F.lit(False), "runs": F.lit(None).cast(judged.schema["runs"].dataType)})
    added = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]
    out = mapped(judged.unionByName(none), _cut(window), T.StructType([keep.schema["_row"], *added]))
    return out.select("_row.*", "n_words", "n_removed", "kept_text")


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS p, w FROM w WHERE len(w) >= 20),
keyed AS (SELECT doc_id, p, md5(array_to_string(w[p:p+19], ' ')) AS k FROM win),
late AS (SELECT doc_id, p FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS r FROM keyed) WHERE r > 1),
gone AS (SELECT doc_id, list(DISTINCT i) AS gone FROM (SELECT doc_id, unnest(range(p, p + 20)) AS i FROM late) GROUP BY doc_id)
SELECT d.doc_id, len(coalesce(w, []))::BIGINT AS n_words, len(coalesce(gone, []))::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN w
    ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i)), lambda i: w[i]) END, ' '), '')) AS kept_sha256
FROM w d LEFT JOIN gone USING (doc_id)
"""
