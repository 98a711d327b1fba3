"""Fill-in-middle rearrangement of texts, cut by a Fenwick tree over fixed blocks.

A unit is a word with the white space before it, or the white space that ends a text. Texts lie in blocks of BLOCK bytes, each
text from a block of its own on; a Fenwick tree holds every block's number of units and of code points. A cut after so many
units is found by binary-lifting descent to its block, and inside the block by counting.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medley.llm import words
from medley.llm.grouped import mapped, parts

BLOCK = 512
SENTINELS = ("<P>", "<S>", "<M>")
SEED = 42
RATE = 50
SPM = 80
ADDED = {"n": T.LongType(), "form": T.StringType(), "prefix_chars": T.LongType(), "middle_chars": T.LongType(), "output": T.StringType()}


def unit_ends(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a unit ends with each byte; ``ends`` are the offsets after each text's last byte."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    last = ~space
    last[:-1] &= space[1:]
    tail = ends[ends > 0] - 1
    last[tail] = True
    return last


class Fenwick:
    """Sums of several rows of counts over blocks, as one binary indexed tree a row."""

    def __init__(self, counts: np.ndarray) -> None:
        self.n = counts.shape[1]
        self.tree = np.concatenate([np.zeros((len(counts), 1), np.int64), counts.astype(np.int64)], axis=1)
        step = 1
        while step <= self.n:
            at = np.arange(step, self.n - step + 1, 2 * step)
            self.tree[:, at + step] += self.tree[:, at]
            step *= 2

    def before(self, block: np.ndarray) -> np.ndarray:
        """Sums over the blocks before each given one."""
        at, out = block.copy(), np.zeros((len(self.tree), len(block)), np.int64)
        while (at > 0).any():
            out += self.tree[:, at]
            at &= at - 1
        return out

    def descend(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block that holds the rank-th (from 1) of the first row's counts, and the sums before it."""
        at, sums = np.zeros(len(rank), np.int64), np.zeros((len(self.tree), len(rank)), np.int64)
        step = 1 << max(0, self.n.bit_length() - 1)
        while step:
            to = np.minimum(at + step, self.n)
            further = (at + step <= self.n) & (sums[0] + self.tree[0, to] < rank)
            at = np.where(further, to, at)
            sums += np.where(further, self.tree[:, to], 0)
            step //= 2
        return at, sums


class Blocks:
    """Texts in blocks, and where they can be cut."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, block: int = BLOCK) -> None:
        self.data, self.offsets, self.block = data, offsets, block
        self.last = unit_ends(data, offsets[1:][offsets[1:] > offsets[:-1]])
        size = np.diff(offsets)
        self.first = np.concatenate([[0], np.cumsum(-(-size // block))])
        owner = np.repeat(np.arange(len(size)), np.diff(self.first))
        self.start = offsets[owner] + (np.arange(len(owner)) - self.first[owner]) * block
        heads = (data & 0xC0) != 0x80
        counts = [np.add.reduceat(x, self.start, dtype=np.int64) if len(owner) else np.zeros(0, np.int64) for x in (self.last, heads)]
        self.tree = Fenwick(np.stack(counts))
        self.base = self.tree.before(self.first)
        self.units, self.chars = self.base[:, 1:] - self.base[:, :-1]

    def cut(self, text: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte offset, and code points of the text before it, of a cut after so many units of each text."""
        to, chars = self.offsets[text].copy(), np.zeros(len(text), np.int64)
        inner = np.flatnonzero(units > 0)
        rank = self.base[0, text[inner]] + units[inner]
        block, sums = self.tree.descend(rank)
        for i, b, left, before in zip(inner, block, rank - sums[0], sums[1], strict=True):
            low = self.start[b]
            high = min(low + self.block, self.offsets[text[i] + 1])
            to[i] = low + np.flatnonzero(self.last[low:high])[left - 1] + 1
            chars[i] = before + np.count_nonzero((self.data[low : to[i]] & 0xC0) != 0x80) - self.base[1, text[i]]
        return to, chars


def rearranged(column: pa.Array, draws: np.ndarray, rate: int, spm: int, sentinels: tuple[str, str, str]) -> list[pa.Array]:
    """The columns of ADDED for texts and their four draws."""
    data, offsets = words.buffers(column)
    blocks = Blocks(data, offsets)
    texts = column.fill_null("")
    taken = pc.or_(pc.or_(*(pc.match_substring(texts, s) for s in sentinels[:2])), pc.match_substring(texts, sentinels[2])).to_numpy(zero_copy_only=False)
    plain = taken | (blocks.units == 0) | (draws[2] % 100 >= rate)
    chosen = np.flatnonzero(~plain)
    one, two = (draws[k][chosen] % (blocks.units[chosen] + 1) for k in (0, 1))
    (a, before), (b, until) = (blocks.cut(chosen, f(one, two)) for f in (np.minimum, np.maximum))
    backward = draws[3][chosen] % 100 < spm
    view = memoryview(data)
    head, mid, tail = (s.encode() for s in sentinels)
    output, low, high = [], offsets[:-1], offsets[1:]
    place = np.full(len(plain), -1)
    place[chosen] = np.arange(len(chosen))
    for i, k in enumerate(place):
        if k < 0:
            output.append(bytes(view[low[i] : high[i]]))
            continue
        prefix, middle, suffix = view[low[i] : a[k]], view[a[k] : b[k]], view[b[k] : high[i]]
        output.append(b"".join([mid, suffix, head, prefix, tail, middle] if backward[k] else [head, prefix, mid, suffix, tail, middle]))
    form = np.full(len(plain), "plain", object)
    form[chosen] = np.where(backward, "spm", "psm")
    chars = np.zeros((2, len(plain)), np.int64)
    chars[:, chosen] = before, until - before
    numbers = [pa.array(x, pa.int64(), mask=plain) for x in chars]
    return [pa.array(blocks.units), pa.array(form, pa.string()), *numbers, pa.array(output, pa.binary()).cast(pa.string())]


def draw(doc_id: str, seed: int, k: int) -> Column:
    """The k-th group of eight hex digits of the SHA-256 of seed, colon and id as a number; a null id counts as no digits."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long")


def check(sentinels: tuple[str, str, str]) -> None:
    """Refuse marks that could be read at a wrong place: no mark may end with what another one, or itself, begins with."""
    if len({*sentinels}) < 3 or not all(sentinels):
        raise ValueError("three different sentinels are needed")
    for a in sentinels:
        for b in sentinels:
            if (a != b and a in b) or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)) + (a != b))):
                raise ValueError(f"sentinels {a!r} and {b!r} overlap")


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """Every row with n (units), form, prefix_chars, middle_chars and output, its text rearranged for filling in the middle.

    Of 100 texts about ``rate`` are rearranged, and of those about ``spm`` of 100 have the suffix first. Draws follow from the id
    alone, so any partitioning and any repetition of a task gives the same; rows that repeat an id draw alike, a null id draws
    as one without digits. A text that is null counts as empty; it, and one that holds a sentinel, stays plain. Input columns
    of the new names are replaced, and all others, whatever their names, go through.
    """
    check(sentinels)
    rows = docs.select([c for c in docs.columns if c.lower() not in ADDED])
    at, names, width = rows.columns.index("text"), [*rows.columns, *ADDED], len(rows.columns)
    drawn = rows.select("*", *(draw("doc_id", seed, k).alias(f"_draw_{k}") for k in range(4)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            draws = np.stack([batch.column(width + k).to_numpy() for k in range(4)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *rearranged(batch.column(at), draws, rate, spm, sentinels)], names)

    return mapped(drawn, run, T.StructType([*rows.schema.fields, *(T.StructField(k, v) for k, v in ADDED.items())]))


def restored(output: str = "output", form: str = "form", sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text before rearrangement, from the output and its form alone."""
    three = F.split(F.col(output), "|".join(re.escape(s) for s in sentinels), 4)
    psm = F.concat(three[1], three[3], three[2])
    spm = F.concat(three[2], three[3], three[1])
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
    sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
c AS (
  SELECT doc_id, t, u, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS one, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS two,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
      WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (
  SELECT *, array_to_string(u[1:least(one, two)], '') AS pre, array_to_string(u[least(one, two) + 1:greatest(one, two)], '') AS mid,
    array_to_string(u[greatest(one, two) + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""
