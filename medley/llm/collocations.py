"""Phrase collocations by Rabin-Karp fingerprints.

Texts are lower-cased (A to Z) and brought to a form in which the words of a phrase stand one space apart, so that a phrase is
one run of bytes; prefix polynomials give the fingerprint of any run in constant time. Only fingerprints travel, each with its
count, the document of one occurrence and the sum of a second, shorter fingerprint over all occurrences. Frequent ones are read
in that document; if the sum is not count times the second fingerprint of what stands there, two phrases share the fingerprint,
and their counts are taken again from the texts. Three-word phrases are only sent where both two-word phrases in them are
frequent, by a bitmap of fixed size which errs on the side of sending.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medley import session
from medley.llm import words
from medley.llm.grouped import mapped, parts, whole_groups

LEAST = 10
TOP = 2000
INSIDE = 50
SCALE = 1_000_000
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
SALT = 0xD6E8FEB86659FD93
CHECK_BITS = 20
BITMAP_BITS = 27
BUCKET_BITS = 14
CHUNK = 1 << 16
FLUSH = 1 << 20
PIECE = 1 << 20
UNKNOWN = "und"
SENT = "fp long, n long, checks long, key long"
PACKED = "bucket int, fp binary, n binary, checks binary, key binary"

KINDS = np.zeros(256, np.uint8)
KINDS[list(b" \t")], KINDS[list(b".,;:!?\n\x0b\x0c\r")] = 1, 2

_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2^64, kept for the next call."""
    if base not in _TABLES or len(_TABLES[base][0]) < size:
        size, made = max(size, 2 * CHUNK), []
        for b in (base, pow(base, -1, 1 << 64)):
            table = np.full(size, np.uint64(b), np.uint64)
            table[0] = 1
            made.append(np.multiply.accumulate(table))
        _TABLES[base] = (made[0], made[1])
    return _TABLES[base]


def polynomials(data: np.ndarray, start: np.ndarray, ends: list[np.ndarray], base: int) -> list[np.ndarray]:
    """For each list of ends the polynomial of every run of bytes from ``start`` to it, from the differences of one prefix sum."""
    up, down = _powers(base, len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    back = down[start]
    return [(sums[end] - sums[start]) * back + (end - start).astype(np.uint64) * np.uint64(SALT) for end in ends]


def salted(values: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """Polynomials of phrases, told apart by language."""
    return words.mix(values + lang)


def sized(values: np.ndarray, k: int | np.ndarray, mask: int) -> np.ndarray:
    """Fingerprints: salted polynomials, of which the last two bits say how many words the phrase has."""
    return (values & np.uint64(mask & ~3)) | np.asarray(k, np.uint64)


def short(values: np.ndarray) -> np.ndarray:
    """The second fingerprint, of CHECK_BITS bits, so that its sum over 2^43 occurrences fits 64 bits."""
    return (values >> np.uint64(64 - CHECK_BITS)).astype(np.int64)


def lang_salt(lang: str) -> np.uint64:
    """What a language adds to its polynomials."""
    data = np.frombuffer(lang.encode(), np.uint8)
    return words.mix(polynomials(data, np.zeros(1, np.int64), [np.array([len(data)])], BASES[0])[0])[0]


def fingerprints(phrases: list[bytes], langs: list[str], mask: int) -> tuple[np.ndarray, np.ndarray]:
    """Both fingerprints of given phrases."""
    data, size = np.frombuffer(b"".join(phrases), np.uint8), np.array([len(p) for p in phrases], np.int64)
    many = np.array([p.count(b" ") + 1 if p else 0 for p in phrases], np.uint64)
    out = [np.zeros(len(phrases), np.uint64) for _ in BASES]
    each = {x: lang_salt(x) for x in set(langs)}
    salt, end = np.array([each[x] for x in langs], np.uint64), np.cumsum(size)
    low = 0
    while low < len(phrases):
        high = max(low + 1, int(np.searchsorted(end, end[low] + CHUNK, "right")))
        a = end[low] - size[low]
        for o, base in zip(out, BASES, strict=True):
            o[low:high] = polynomials(data[a : end[high - 1]], end[low:high] - size[low:high] - a, [end[low:high] - a], base)[0]
        low = high
    return sized(salted(out[0], salt), many, mask), short(salted(out[1], salt))


class Words:
    """The words of many texts, and which follow each other within a piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        kind, data = KINDS[data], words.lower_ascii(data)
        parted, inside = kind == 2, kind == 0
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        filled = offsets[:-1] < offsets[1:]
        heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
        first[heads] |= inside[heads]
        last[tails] |= inside[tails]
        place, until = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.row = np.searchsorted(offsets, place, "right") - 1
        gaps = np.concatenate([[0], np.cumsum(parted, dtype=np.int32)])
        self.joined = (self.row[1:] == self.row[:-1]) & (gaps[place[1:]] == gaps[until[:-1]])
        kept = inside.copy()
        kept[1:] |= inside[:-1]
        at = np.concatenate([[0], np.cumsum(kept)])
        self.start, self.end = at[place], at[until]
        self.data = np.where(inside, data, np.uint8(32))[kept]

    def phrases(self, k: int) -> np.ndarray:
        """Whether a phrase of ``k`` words starts with each word."""
        n = len(self.start)
        out = np.zeros(n, bool)
        if n >= k:
            out[: n - k + 1] = True
            for j in range(k - 1):
                out[: n - k + 1] &= self.joined[j : n - k + 1 + j]
        return out

    def hashed(self, low: int, high: int, sizes: list[int], base: int, salts: np.ndarray) -> list[np.ndarray]:
        """Salted polynomials of the runs of so many words, rising, from each word of the range; one over the last word ends there."""
        stop = [np.minimum(np.arange(low, high) + k - 1, len(self.end) - 1) for k in sizes]
        a, b = self.start[low], self.end[stop[-1][-1]]
        values = polynomials(self.data[a:b], self.start[low:high] - a, [self.end[s] - a for s in stop], base)
        return [salted(v, salts[self.row[low:high]]) for v in values]

    def ranges(self) -> Iterator[tuple[int, int]]:
        """Ranges of words of about CHUNK bytes, one word at least."""
        low, n = 0, len(self.start)
        while low < n:
            high = min(n, max(low + 1, int(np.searchsorted(self.end, self.start[low] + CHUNK, "right"))))
            yield low, high
            low = high


def grouped(fp: np.ndarray, n: np.ndarray, checks: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, ...]:
    """Fingerprints in rising order, unsigned, each once, with count, sum of checks and least key."""
    order = np.argsort(fp.view(np.uint64))
    fp = fp[order]
    head = np.flatnonzero(np.concatenate([[True], fp[1:] != fp[:-1]])) if len(fp) else np.zeros(0, np.int64)
    if len(head) == len(fp):
        return fp.view(np.int64), n[order], checks[order], key[order]
    return fp[head].view(np.int64), np.add.reduceat(n[order], head), np.add.reduceat(checks[order], head), np.minimum.reduceat(key[order], head)


def joined(found: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Pieces of columns put together."""
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def packed(columns: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    """PACKED of rows in the order of their fingerprints: those with the same first bits stand in one bucket, a cell for each column."""
    bucket = (columns[0].view(np.uint64) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
    head = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    ends = pa.py_buffer(np.append(head, len(bucket)).astype(np.int32) * np.int32(8))
    cells = [pa.Array.from_buffers(pa.binary(), len(head), [None, ends, pa.py_buffer(np.ascontiguousarray(c))]) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(bucket[head]), *cells], [x.split()[0] for x in PACKED.split(", ")])


def unpacked(cells: pa.ChunkedArray) -> np.ndarray:
    """The numbers of a packed column, all cells after each other."""
    found = []
    for c in cells.chunks:
        ends = np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1]
        found.append(np.frombuffer(c.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(np.int64))
    return np.concatenate(found)


def known(bits: np.ndarray, fp: np.ndarray) -> np.ndarray:
    """Whether the bitmap holds each fingerprint's bit."""
    where = (fp >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
    return (bits[where >> 3] >> (where & 7).astype(np.uint8)) & 1 == 1


KINDS_OF = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}


def batch_of(columns: list | tuple, schema: str) -> pa.RecordBatch:
    """Columns as a batch of a schema."""
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS_OF[t]) for c, (_, t) in zip(columns, fields, strict=True)], [f for f, _ in fields])


def count_phrases(docs: DataFrame, sizes: list[int], mask: int, bitmap: Broadcast | None = None, least: int = 1) -> DataFrame:
    """SENT for the phrases of so many words (0: of none, once a word), summed up per part of the input and then by fingerprint.

    With a bitmap, only phrases whose two-word phrases are both in it; only fingerprints found ``least`` times. What a part
    has found travels packed by the first bits of the fingerprint: 2^BUCKET_BITS buckets, of which a task sums some at a time.
    """

    def of(rows: pa.RecordBatch, bits: np.ndarray | None) -> Iterator[tuple[np.ndarray, ...]]:
        at = Words(*words.buffers(rows.column("text")))
        langs, keys = rows.column("lang").to_pylist(), rows.column("key").to_numpy()
        each = {x: lang_salt(x) for x in set(langs)}
        salts = np.array([each[x] for x in langs], np.uint64)
        asked = [k for k in sizes if k]
        starts = {k: at.phrases(k) for k in asked}
        if 0 in sizes and len(at.row):
            sums = np.bincount(at.row, minlength=len(langs))
            held = np.flatnonzero(sums)
            empty = salted(np.zeros(len(held), np.uint64), salts[held])
            yield sized(empty, 0, mask), sums[held], short(empty) * sums[held], keys[held]
        for low, high in at.ranges():
            own = {k: np.flatnonzero(starts[k][low:high]) for k in asked}
            if bits is not None:
                pairs = at.hashed(low, min(high + 1, len(at.start)), [2], BASES[0], salts)[0]
                seen = known(bits, sized(pairs, 2, mask))
                own = {k: v[seen[v] & seen[np.minimum(v + 1, len(seen) - 1)]] for k, v in own.items()}
            one, two = (at.hashed(low, high, asked, b, salts) for b in BASES)
            for k, v, c in zip(asked, one, two, strict=True):
                i = own[k]
                yield sized(v[i], k, mask), np.ones(len(i), np.int64), short(c[i]), keys[at.row[low + i]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if bitmap is None else np.frombuffer(bitmap.value, np.uint8)
        found, waiting = [], 0
        for batch in parts(batches, PIECE):
            for piece in of(batch, bits):
                found.append(piece)
                waiting += len(piece[0])
                if waiting >= FLUSH:
                    yield packed(grouped(*joined(found)))
                    found, waiting = [], 0
        if waiting:
            yield packed(grouped(*joined(found)))

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["bucket"]):
            found = grouped(*(unpacked(rows.column(c)) for c in range(1, 5)))
            often = found[1] >= least
            yield batch_of([c[often] for c in found], SENT)

    return mapped(mapped(docs, run, PACKED).repartition("bucket").sortWithinPartitions("bucket"), total, SENT)


def bitmap_of(fps: DataFrame, column: str = "fp") -> bytes:
    """2^BITMAP_BITS bits, of which each fingerprint sets the one that its first bits name: 16 MB, whatever the input."""
    place = F.shiftrightunsigned(column, 64 - BITMAP_BITS)
    rows = fps.select(F.shiftright(place, 15).alias("bucket"), place.bitwiseAND(32767).alias("bit"))
    out = np.zeros((1 << BITMAP_BITS) // 8, np.uint8)
    for bucket, bits in rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit")).collect():
        out[bucket * 4096 : bucket * 4096 + 4096] = np.frombuffer(bits, np.uint8)
    return out.tobytes()


READ = "fp long, lang string, phrase string, n long, agreed boolean"
PHRASE = "fp long, lang string, phrase string, n long"
ASKED = "lang string, phrase string, fp long, check long"


def pointed(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The documents whose key is among those of ``wanted``, and a few more, by a bitmap of fixed size: less to shuffle."""
    spread = wanted.select(F.xxhash64("key").alias("spread"))
    bits, names = docs.sparkSession.sparkContext.broadcast(bitmap_of(spread, "spread")), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            keep = known(held, batch.column("spread").to_numpy().view(np.uint64))
            yield batch.filter(pa.array(keep)).select(names)

    return mapped(docs.withColumn("spread", F.xxhash64("key")), run, docs.schema)


def read_phrases(docs: DataFrame, wanted: DataFrame, mask: int) -> DataFrame:
    """READ for fingerprints of phrases: what their document holds under each, and whether that accounts for all occurrences.

    A document is asked for no more fingerprints than it has phrases. Rows that share a key are all looked at; one of them
    holds the phrase.
    """
    places = wanted.groupBy("key").agg(F.collect_list(F.struct("fp", "n", "checks")).alias("places"))
    rows = pointed(docs, wanted).join(session.materialise(places, "places"), "key").select("key", "lang", "text", "places")
    sizes = [2, 3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, PIECE):
            at, langs, keys = Words(*words.buffers(batch.column("text"))), batch.column("lang").to_pylist(), batch.column("key").to_numpy()
            asked = batch.column("places").flatten()
            fp, n, checks = (asked.field(k).to_numpy() for k in range(3))
            owner = np.repeat(keys, batch.column("places").value_lengths().to_numpy())
            order = np.argsort(fp, kind="stable")
            order = order[np.concatenate([[True], fp[order][1:] != fp[order][:-1]])]
            fp, n, checks, owner = fp[order], n[order], checks[order], owner[order]
            each = {x: lang_salt(x) for x in set(langs)}
            salts = np.array([each[x] for x in langs], np.uint64)
            starts = {k: at.phrases(k) for k in sizes}
            found: dict[int, tuple[int, str, str, int, bool]] = {}
            for low, high in at.ranges():
                one, two = (at.hashed(low, high, sizes, b, salts) for b in BASES)
                for k, v, c in zip(sizes, one, two, strict=True):
                    got = sized(v, k, mask).view(np.int64)
                    where = np.minimum(np.searchsorted(fp, got), len(fp) - 1)
                    hit = np.flatnonzero(starts[k][low:high] & (fp[where] == got) & (owner[where] == keys[at.row[low:high]]))
                    _, first = np.unique(where[hit], return_index=True)
                    for i in hit[first]:
                        j, check = int(where[i]), int(short(c[i : i + 1])[0])
                        if j not in found:
                            phrase = at.data[at.start[low + i] : at.end[low + i + k - 1]].tobytes().decode()
                            found[j] = (int(fp[j]), langs[at.row[low + i]], phrase, int(n[j]), check * int(n[j]) == int(checks[j]))
            yield batch_of(list(zip(*found.values(), strict=True)) if found else [[]] * 5, READ)

    return mapped(rows, run, READ).distinct()


def recount(docs: DataFrame, shared: DataFrame, sizes: list[int], mask: int) -> DataFrame:
    """PHRASE, counted from the texts, for all phrases of so many words whose fingerprints are among ``shared``."""
    bits = docs.sparkSession.sparkContext.broadcast(bitmap_of(shared))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(bits.value, np.uint8)
        for batch in parts(batches, PIECE):
            at, langs = Words(*words.buffers(batch.column("text"))), batch.column("lang").to_pylist()
            salts = np.array([lang_salt(x) for x in langs], np.uint64)
            starts = {k: at.phrases(k) for k in sizes if k}
            found: Counter[tuple[int, str, bytes]] = Counter()
            empty = sized(salted(np.zeros(len(langs), np.uint64), salts), 0, mask) if 0 in sizes else np.zeros(0, np.uint64)
            for i in np.flatnonzero(known(held, empty)):
                found[int(empty.view(np.int64)[i]), langs[i], b""] += int((at.row == i).sum())
            for low, high in at.ranges():
                for k, v in zip(starts, at.hashed(low, high, list(starts), BASES[0], salts), strict=True):
                    fp = sized(v, k, mask)
                    for j in np.flatnonzero(starts[k][low:high] & known(held, fp)):
                        phrase = at.data[at.start[low + j] : at.end[low + j + k - 1]].tobytes()
                        found[int(fp.view(np.int64)[j]), langs[at.row[low + j]], phrase] += 1
            rows = [(f, lang, p.decode(), n) for (f, lang, p), n in found.items()]
            yield batch_of(list(zip(*rows, strict=True)) if rows else [[]] * 4, PHRASE)

    counts = mapped(docs, run, PHRASE).groupBy("fp", "lang", "phrase").agg(F.sum("n").alias("n"))
    return counts.join(shared.select("fp").distinct(), "fp", "left_semi")


def counts_of(phrases: DataFrame, docs: DataFrame, counts: DataFrame, sizes: list[int], mask: int) -> DataFrame:
    """lang, phrase and n for distinct phrases, from counts by fingerprint where the check agrees, else from the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, PIECE):
            lang, phrase = (c.to_pylist() for c in batch.columns)
            fp, check = fingerprints([x.encode() for x in phrase], lang, mask)
            yield batch_of([lang, phrase, fp.view(np.int64), check], ASKED)

    asked = mapped(phrases.select("lang", "phrase"), run, ASKED).join(counts.select("fp", "n", "checks"), "fp", "left")
    asked = session.materialise(asked.withColumn("sure", F.coalesce(F.col("check") * F.col("n") == F.col("checks"), F.lit(False))), "counts")
    sure, doubtful = asked.where("sure").select("lang", "phrase", "n"), asked.where("NOT sure")
    if doubtful.isEmpty():
        return sure
    again = session.materialise(recount(docs, doubtful.select("fp"), sizes, mask), "recounted")
    return sure.unionByName(doubtful.select("lang", "phrase").join(again.select("lang", "phrase", "n"), ["lang", "phrase"]))


def cuts_of(found: DataFrame) -> DataFrame:
    """Every phrase with the two parts of each cut."""
    each = F.split("phrase", " ")
    part = lambda start, size: F.array_join(F.slice(each, start, size), " ")
    cut = lambda k: F.struct(F.lit(k).alias("cut"), part(1, k).alias("first"), part(k + 1, F.size(each) - k).alias("rest"))
    return found.select("lang", "phrase", F.col("n").alias("a"), F.inline(F.when(F.size(each) == 2, F.array(cut(1))).otherwise(F.array(cut(1), cut(2)))))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, inside: int = INSIDE, bits: int = 64) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the strongest phrases of two and three words of each language.

    Words are runs without blank or tab in the pieces between ``.,;:!?`` and line ends, A to Z lower-cased. A phrase of at least
    ``least`` occurrences within pieces is a candidate; its score is floor(1000000 a a / (l r)) of the weakest cut into two parts,
    of equal ones the first. A candidate goes if a longer one that holds it has at least ``inside`` of 100 of its occurrences.
    ``top`` rows of a language stay by score and occurrences, both falling, then phrase. A null language counts as ``und``,
    a null text as empty; rows that repeat an id, or have none, count like all others, and columns besides doc_id, text and lang
    are not looked at; without phrases the result is empty. ``bits`` of a fingerprint are used: fewer only mean that more counts
    are taken from the texts.
    """
    mask = ((1 << bits) - 1) << (64 - bits)
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text))
    rows = docs.select(key.alias("key"), F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), text.alias("text"))
    size = F.col("fp").bitwiseAND(3)
    grams = session.materialise(count_phrases(rows, [0, 1, 2], mask, least=least), "grams")
    pairs = docs.sparkSession.sparkContext.broadcast(bitmap_of(grams.where(size == 2)))
    triples = session.materialise(count_phrases(rows, [3], mask, pairs, least), "grams")
    read = session.materialise(read_phrases(rows, grams.where(size == 2).unionByName(triples), mask), "phrases")
    found, shared = read.where("agreed").select("lang", "phrase", "n"), read.where("NOT agreed")
    if not shared.isEmpty():
        again = session.materialise(recount(rows, shared.select("fp"), [2, 3], mask), "recounted")
        found = found.unionByName(again.where(F.col("n") >= least).select("lang", "phrase", "n"))
    cuts = cuts_of(found)
    asked = cuts.select("lang", F.explode(F.array("first", "rest", F.lit(""))).alias("phrase")).distinct()
    counts = session.materialise(counts_of(asked, rows, grams, [0, 1, 2], mask), "counts")
    one, two, all_words = (counts.select("lang", F.col("phrase").alias(p), F.col("n").alias(c)) for p, c in (("first", "l"), ("rest", "r"), ("none", "n")))
    scored = cuts.join(one, ["lang", "first"]).join(two, ["lang", "rest"])
    ratio = F.expr(f"CAST({SCALE} * CAST(a AS decimal(15,0)) * CAST(a AS decimal(15,0)) AS decimal(38,0)) DIV (CAST(l AS decimal(15,0)) * CAST(r AS decimal(15,0)))")
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct(ratio.alias("score"), "cut", "l", "r")).alias("weakest"))
    longer = cuts.where(F.size(F.split("phrase", " ")) == 3).select("lang", F.col("a").alias("more"), F.when(F.col("cut") == 1, F.col("rest")).otherwise(F.col("first")).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("more").alias("more"))
    own = weakest.join(longer, ["lang", "phrase"], "left").where(F.col("more").isNull() | (100 * F.col("more") < inside * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = own.select("lang", "phrase", "a", "weakest.l", "weakest.r", "weakest.score").withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(all_words.where("none = ''").drop("none"), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
words AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, k, phrase, count(*) AS f FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM w, (VALUES (1), (2), (3)) AS sizes(k) WHERE len(w) >= k) GROUP BY lang, k, phrase HAVING count(*) >= 10),
cut AS (
  SELECT lang, k, phrase, f AS a, c, array_to_string(string_split(phrase, ' ')[1:c], ' ') AS first, array_to_string(string_split(phrase, ' ')[c + 1:], ' ') AS rest
  FROM g, (VALUES (1), (2)) AS cuts(c) WHERE k > c),
scored AS (
  SELECT x.*, l.f AS l, r.f AS r, ((1000000::HUGEINT * x.a * x.a) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cut x JOIN g l ON l.lang = x.lang AND l.phrase = x.first AND l.k = x.c JOIN g r ON r.lang = x.lang AND r.phrase = x.rest AND r.k = x.k - x.c),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase, k ORDER BY score, c) = 1),
longer AS (SELECT lang, CASE c WHEN 1 THEN rest ELSE first END AS phrase, max(a) AS more FROM cut WHERE k = 3 GROUP BY ALL),
own AS (SELECT s.* FROM weakest s LEFT JOIN longer o ON o.lang = s.lang AND o.phrase = s.phrase AND s.k = 2 WHERE o.more IS NULL OR 100 * o.more < 50 * s.a)
SELECT o.lang, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM own o JOIN words USING (lang)
QUALIFY row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""
