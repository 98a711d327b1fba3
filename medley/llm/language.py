"""Language identification by rank-order profiles of character n-grams and out-of-place distance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medley.llm import base
from medley.llm.grouped import mapped, parts

TOP = 300
SAMPLE = 600
SLICE_CHARS, SLICE_ROWS = 1 << 20, 256
POINTS = 0x110000

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(POINTS)), bool, POINTS))
    return _LETTERS[0]


def counted_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, gram and count of the 1- to 3-grams of each text, of at most 256 texts; of a row the most frequent first.

    Texts are lower-cased; every run of characters that are not letters is one boundary mark, which counts as a
    character of 2- and 3-grams but not in the middle of one. Ties come by n and then by code points. A gram is three
    code points in one integer, and so orders like that.
    """
    lower = [t.lower() for t in texts]
    points = np.frombuffer(("\0" + "\0".join(lower) + "\0").encode("utf-32-le", "replace"), np.uint32).copy()
    row = np.repeat(np.arange(len(lower)), [len(t) + 1 for t in lower])
    row = np.append(row, len(lower) - 1) if len(points) > len(row) else row
    points[~_letters()[points]] = 0
    keep = points > 0
    keep[1:] |= points[:-1] > 0
    keep[0] = True
    points, row = points[keep], row[keep]
    seen = np.zeros(POINTS, bool)
    seen[points] = True
    seen[0] = True
    alphabet = np.flatnonzero(seen).astype(np.uint64)
    dense = np.zeros(POINTS, np.uint64)
    dense[alphabet] = np.arange(len(alphabet), dtype=np.uint64)
    alphabet[0] = 32  # the boundary mark is a character of its own, unlike the places that shorter grams lack
    bits = np.uint64(max(1, int(len(alphabet) - 1).bit_length()))
    c = dense[points]
    r = row.astype(np.uint64)
    three = np.uint64(3) * bits
    head = lambda rows, n: (rows << (three + np.uint64(2))) | (np.uint64(n) << three)
    one = (head(r, 1) | c)[c > 0]
    # a boundary that ends one text begins the next: its 2-gram belongs to the text of the letter
    pair = (c[:-1] << bits) | c[1:]
    two = (head(np.where(c[:-1] > 0, r[:-1], r[1:]), 2) | pair)[pair > 0]
    triple = (c[:-2] << (bits + bits)) | (c[1:-1] << bits) | c[2:]
    tri = (head(r[1:-1], 3) | triple)[c[1:-1] > 0]
    keys = np.sort(np.concatenate([one, two, tri]))
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    count = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    rows = (keys >> (three + np.uint64(2))).astype(np.int64)
    order = np.argsort((rows << 32) - count, kind="stable")
    rows, keys, count = rows[order], keys[order], count[order]
    mask = (np.uint64(1) << bits) - np.uint64(1)
    size = (keys >> three) & np.uint64(3)
    one, two, tri = (np.where(size > k, alphabet[(keys >> (np.uint64(k) * bits)) & mask], np.uint64(0)) for k in range(3))
    gram = (tri << np.uint64(42)) | (two << np.uint64(21)) | one
    return rows, gram, count


def top_grams(texts: list[str], top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, gram and rank (from 0) of the ``top`` first grams of each text."""
    rows, gram, _ = counted_grams(texts)
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows, "left")
    best = rank < top
    return rows[best], gram[best], rank[best]


def slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of at most 256 texts and about a million characters."""
    low = 0
    while low < len(texts):
        high, size = low, 0
        while high < len(texts) and high - low < SLICE_ROWS and (high == low or size + len(texts[high]) <= SLICE_CHARS):
            size += len(texts[high])
            high += 1
        yield low, high
        low = high


class Profiles:
    """Ranks of each language's most frequent n-grams."""

    def __init__(self, names: list[str], grams: np.ndarray, ranks: np.ndarray, top: int) -> None:
        self.names, self.grams, self.ranks, self.top = names, grams, ranks, top

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language of least out-of-place distance and d2 / (d1 + d2) of the two least distances."""
        names, scores = [], []
        filled = [t or "" for t in texts]
        for low, high in slices(filled):
            row, gram, rank = top_grams(filled[low:high], self.top)
            size = np.bincount(row, minlength=high - low)
            if not self.names:
                names += ["und"] * (high - low)
                scores += [0.0] * (high - low)
                continue
            at = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
            known = self.grams[at] == gram
            distance = np.empty((high - low, len(self.names)))
            for k in range(len(self.names)):
                theirs = np.where(known, self.ranks[at, k], -1)
                apart = np.where(theirs < 0, self.top, np.abs(theirs - rank))
                distance[:, k] = np.bincount(row, apart, high - low)
            best = distance.argmin(1)
            two = np.sort(distance, 1)[:, :2] if len(self.names) > 1 else np.column_stack([distance, size * self.top])
            total = two.sum(1)
            score = np.where(total > 0, two[:, -1] / np.where(total > 0, total, 1), 0.5)
            names += [self.names[b] if n else "und" for b, n in zip(best, size, strict=True)]
            scores += [float(s) if n else 0.0 for s, n in zip(score, size, strict=True)]
        return names, scores


def profiles(names: list[str], found: list[tuple[np.ndarray, np.ndarray]], top: int) -> Profiles:
    """Profiles from the grams and ranks of each language."""
    grams = np.unique(np.concatenate([g for g, _ in found])) if found else np.zeros(0, np.uint64)
    names = names if len(grams) else []
    ranks = np.full((len(grams), len(names)), -1, np.int64)
    for k in range(len(names)):
        ranks[np.searchsorted(grams, found[k][0]), k] = found[k][1]
    return Profiles(names, grams, ranks, top)


def learn(sample: DataFrame, top: int = TOP) -> Profiles:
    """Profiles of each language from labelled texts (``text``, ``label``), read whole.

    Grams are counted batch by batch and summed by Spark; of each language only its ``top`` first come to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            texts, langs = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), object)
            for low, high in slices(texts):
                row, gram, n = counted_grams(texts[low:high])
                yield pa.RecordBatch.from_arrays([pa.array(langs[low:high][row], pa.string()), pa.array(gram.view(np.int64)), pa.array(n)], ["label", "gram", "n"])

    grams = mapped(sample.select("text", F.col("label").cast("string")), run, "label string, gram long, n long")
    order = Window.partitionBy("label").orderBy(F.desc("n"), "gram")
    ranked = grams.groupBy("label", "gram").agg(F.sum("n").alias("n")).withColumn("rank", F.row_number().over(order) - 1)
    kept = ranked.where(F.col("rank") < top).select("label", "gram", "rank").toPandas()
    names = sorted(kept["label"].unique())
    own = [kept[kept["label"] == name].sort_values("rank") for name in names]
    return profiles(names, [(x["gram"].to_numpy(np.int64).view(np.uint64), x["rank"].to_numpy(np.int64)) for x in own], top)


def identify(docs: DataFrame, sample: int = SAMPLE, top: int = TOP) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row.

    Profiles are learned from about ``sample`` documents per language that are not held out; every whole text is counted,
    ranked and compared. A null text, one without a letter, or a table without any usable lang gives ``und`` and 0. Rows with
    equal ids each get a row; a null id is scored too. Equal distances go to the language first in order of name.
    """
    labelled = docs.select("doc_id", F.col("lang").alias("label"))
    model = learn(base.training_sample(docs, labelled, sample, "lang", None), top)

    def compute(texts: pa.Array) -> list[pa.Array]:
        names, scores = model.predict(texts.to_pylist())
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), base.held_out().alias("held_out"), "text")
    scored = base.annotate(rows, "text", {"lang_pred": T.StringType(), "score": T.DoubleType()}, compute)
    return scored.select("doc_id", "held_out", "lang_pred", "score")
