"""MinHash near-duplicates by an inverted join over signature coordinates.

Equal shingle sets become one class first. A class posts itself under (coordinate, value) pairs of its signature. Two
signatures that agree in ``matches`` of their COORDINATES must share one of each one's rarest postings, all but matches - 1
of them (the others cannot hold all their agreements), so only those are joined, and a pair is taken up in the first posting that it
shares and skipped in all others. Pairs in one posting are compared in numpy, block against block, and never written out:
first signatures alone name the members that have any partner, then those members' full sets confirm the links, of which a
spanning forest leaves the task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medley import session
from medley.llm import words
from medley.llm.components import components
from medley.llm.grouped import mapped, parts, whole_groups

COORDINATES = 24
MISS = 1.5e-6
BLOCK = 512
PAIRS = 100_000

_SALT = words.mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ODD = words.mix(_SALT) | np.uint64(1)
_ROLL = [np.uint64(0x8CB92BA72F3D8DD7), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]


def matches(percent: int) -> int:
    """The most coordinates that all but MISS of the pairs at a similarity of ``percent`` / 100 agree in; 43 percent at least."""
    p, missed, found = percent / 100, 0.0, 0
    for k in range(COORDINATES):
        missed += comb(COORDINATES, k) * p**k * (1 - p) ** (COORDINATES - k)
        if missed > MISS:
            break
        found = k + 1
    if not found or percent > 100:
        raise ValueError(f"{COORDINATES} coordinates cannot find pairs at {percent} percent")
    return found


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit hashes of the word shingles of every text, in order; fewer words make one shingle."""
    data, offsets = words.buffers(column)
    for low, high in words.slices(offsets):
        part, own = words.lower_ascii(data[offsets[low] : offsets[high]]), offsets[low : high + 1] - offsets[low]
        row, start, end = words.spans(part, own)
        hashed = words.hashes(part, start, end)
        ends = np.searchsorted(row, np.arange(high - low), "right")
        rolled = np.zeros(max(0, len(hashed) - size + 1), np.uint64)
        for k in range(size):
            rolled = words.mix(rolled * _ROLL[0] + hashed[k : k + len(rolled)] * _ROLL[1] + _ROLL[2])
        begin = 0
        for stop in ends:
            n = stop - begin
            if n >= size:
                yield np.unique(rolled[begin : stop - size + 1])
            elif n:
                one = np.array([n], np.uint64)
                for k in range(begin, stop):
                    one = words.mix(one * _ROLL[0] + hashed[k : k + 1] * _ROLL[1] + _ROLL[2])
                yield one
            else:
                yield np.zeros(0, np.uint64)
            begin = stop


def signature(grams: np.ndarray) -> np.ndarray:
    """The least salted hash of the set for each coordinate, as 32 bits."""
    out = np.empty(COORDINATES, np.uint64)
    for k in range(COORDINATES):
        out[k] = ((grams ^ _SALT[k]) * _ODD[k]).min()
    return (out >> np.uint64(32)).astype(np.uint32)


def _signatures(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            count, digest, sig = [], [], []
            for grams in shingle_sets(batch.column(1), size):
                count.append(len(grams))
                digest.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None)
                sig.append(signature(grams).tobytes() if len(grams) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())],
                ["doc_id", "n_shingles", "digest", "sig"],
            )

    return run


def _pairs(group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of rows of one group, in bounded pieces; ``group`` is sorted."""
    ends = np.searchsorted(group, group, "right")
    left = ends - np.arange(len(group)) - 1
    total = np.concatenate([[0], np.cumsum(left)])
    low = 0
    while low < len(group):
        high = max(low + 1, int(np.searchsorted(total, total[low] + PAIRS, "right")) - 1)
        n = left[low:high]
        a = np.repeat(np.arange(low, high), n)
        b = a + 1 + np.arange(len(a)) - np.repeat(total[low:high] - total[low], n)
        if len(a):
            yield a, b
        low = high


class _Members:
    """Rows of several groups as arrays."""

    def __init__(self, rows: pa.Table) -> None:
        take = lambda name: rows.column(name).to_numpy()
        self.key, self.i, self.j, self.rep, self.n = (take(c) for c in ("key", "i", "j", "rep", "n"))
        self.block, self.prefix = take("block"), take("prefix").astype(np.int64)
        self.sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint32).reshape(-1, COORDINATES)
        new = np.ones(len(self.key), bool)
        new[1:] = (self.key[1:] != self.key[:-1]) | (self.i[1:] != self.i[:-1]) | (self.j[1:] != self.j[:-1])
        self.group = np.cumsum(new) - 1
        self.bits = np.int64(1) << np.arange(COORDINATES, dtype=np.int64)

    def partners(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs to take up in this posting: different blocks of a block pair, sizes and agreements that can reach."""
        least = matches(percent)
        for a, b in _pairs(self.group):
            ok = (self.i[a] == self.j[a]) | (self.block[a] != self.block[b])
            ok &= 100 * np.minimum(self.n[a], self.n[b]) >= percent * np.maximum(self.n[a], self.n[b])
            a, b = a[ok], b[ok]
            same = self.sig[a] == self.sig[b]
            ok = same.sum(1) >= least
            a, b, same = a[ok], b[ok], same[ok]
            shared = (same * self.bits).sum(1) & self.prefix[a] & self.prefix[b]
            ok = (shared & -shared) == self.bits[self.key[a] & 31]
            yield a[ok], b[ok]


def _active(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Members with at least one partner to confirm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["key", "i", "j"]):
            has = np.zeros(rows.num_rows, bool)
            for a, b in _Members(rows).partners(percent):
                has[a] = has[b] = True
            yield from rows.filter(pa.array(has)).combine_chunks().to_batches()

    return run


def _confirm(shingle: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links confirmed on full sets, of each group only those that join two parts not joined before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["key", "i", "j"]):
            m = _Members(rows)
            grams = list(shingle_sets(rows.column("text"), shingle))
            parent = np.arange(len(grams))
            found: list[tuple[int, int]] = []
            for a, b in m.partners(percent):
                # by first member: its set against those of all partners of another part at once
                for x in np.unique(a):
                    others = b[a == x]
                    others = others[_roots(parent, others) != _roots(parent, np.array([x]))[0]]
                    if not len(others):
                        continue
                    sizes = np.array([len(grams[k]) for k in others])
                    flat = np.concatenate([grams[k] for k in others])
                    at = np.minimum(np.searchsorted(grams[x], flat), len(grams[x]) - 1)
                    common = np.add.reduceat((grams[x][at] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
                    union = len(grams[x]) + sizes - common
                    for y in others[100 * common >= percent * union]:
                        p, q = _roots(parent, np.array([x, y]))
                        if p != q:
                            parent[max(p, q)] = min(p, q)
                            found.append((x, y))
            pair = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(m.rep[pair[:, 0]]), pa.array(m.rep[pair[:, 1]])], ["a", "b"])

    return run


def _roots(parent: np.ndarray, of: np.ndarray) -> np.ndarray:
    while True:
        up = parent[of]
        if (up == of).all():
            return of
        of = up


def classes(docs: DataFrame, shingle: int) -> tuple[DataFrame, DataFrame]:
    """Set size and digest of every row; of every digest its least doc_id (rep), size and signature."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = session.materialise(mapped(rows, _signatures(shingle), "doc_id long, n_shingles long, digest binary, sig binary"), "signatures")
    filled = rows.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    reps = filled.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n"), F.min("sig").alias("sig"))
    return rows.select("doc_id", "n_shingles", "digest"), session.materialise(reps, "classes")


def postings(reps: DataFrame, least: int) -> DataFrame:
    """The rare postings of every class that some other class shares: rep, n, sig, prefix, key and its frequency.

    A key holds its coordinate in the lowest five bits. Ties of frequency go by key, the same everywhere. ``prefix`` has a
    bit for each coordinate of the class that is among its rarest, all but least - 1; those that no other class has count as rarest.
    """
    part = [
        F.shiftleft(F.conv(F.hex(F.substring("sig", 4 * k + 1, 4)), 16, 10).cast("long"), 5).bitwiseOR(F.lit(k)).alias(str(k))
        for k in range(COORDINATES)
    ]
    keys = reps.select("rep", F.explode(F.array(*part)).alias("key"))
    # read from a table, a frequent key's side of the join can be split
    shared = session.materialise(keys.groupBy("key").agg(F.count("*").alias("freq")).where("freq > 1"), "postings")
    mine = keys.join(shared, "key").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("freq", "key"))).alias("all"))
    kept = mine.select("rep", F.expr(f"slice(all, 1, greatest(0, size(all) - {least - 1}))").alias("kept")).where("size(kept) > 0")
    bit = F.aggregate("kept", F.lit(0), lambda a, p: a.bitwiseOR(F.call_function("shiftleft", F.lit(1), p["key"].bitwiseAND(F.lit(31)).cast("int"))))
    kept = kept.withColumn("prefix", bit)
    rows = kept.join(reps.select("rep", "n", "sig"), "rep").select("rep", "n", "sig", "prefix", F.explode("kept").alias("p"))
    return rows.select("rep", "n", "sig", "prefix", "p.key", "p.freq")


def _blocked(rows: DataFrame) -> DataFrame:
    """Every posting's members in blocks of about BLOCK, each copied to every pair of blocks that it is in."""
    blocks = F.ceil(F.col("freq") / BLOCK).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "rep", "n", "sig", "prefix", "block")


def links(docs: DataFrame, reps: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links between class representatives that join all that are linked: a spanning forest of every block pair's links."""
    rows = _blocked(postings(reps, matches(percent)))
    width = "key long, i int, j int, rep long, n long, sig binary, prefix int, block int"
    near = mapped(rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "rep"), _active(percent), width)
    near = session.materialise(near, "candidates")
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    full = near.join(texts, "rep").select(*near.columns, "text")
    return mapped(full.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "rep"), _confirm(shingle, percent), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row: documents of Jaccard similarity ``percent`` / 100 or more.

    Words are runs of bytes other than space and 0x09-0x0D, A-Z in lower case; a set holds the distinct shingles of
    ``shingle`` words, or the whole sequence where there are fewer. A null, empty or blank text, and a null id, is linked
    with nothing. component_id is the least id reachable by links, the own one included; kept says that it is the own id.
    Links are exact once found; a pair at the threshold agrees in fewer coordinates than ``matches`` asks for, and so may be
    missed, with a chance of at most MISS. A ``percent`` under 43 is refused. Rows that repeat an id share that id's class and each get a row, but an id
    should name one text: of several under one id, links are confirmed on one.
    """
    rows, reps = classes(docs, shingle)
    found = components(links(docs, reps, shingle, percent))
    named = reps.join(found, reps["rep"] == found["node"], "left").select("digest", F.coalesce("component", "rep").alias("least"))
    rows = rows.join(named, "digest", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id")
    return rows.select("doc_id", "n_shingles", own).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i:i+2])
    WHEN len(w) > 0 THEN [w] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN n USING (doc_id)
"""
