"""Near-duplicate embeddings by randomised-rotation binary codes.

A unit vector is turned by a random rotation and stored as the signs of its coordinates with one correction factor, the
inner product of vector and code. Code times rotated vector over the factor is an unbiased estimate of the cosine, and its
error has a known spread; only pairs whose estimate comes within the confidence bound of the threshold are computed exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medley import session
from medley.llm.components import components
from medley.llm.grouped import mapped, whole_groups

SPREADS = 5.0
BLOCK = 1024
PAIRS = 1 << 16
SEED = 20

_ROTATIONS: dict[int, np.ndarray] = {}


def rotation(size: int) -> np.ndarray:
    """A random orthogonal matrix, the same on every worker."""
    if size not in _ROTATIONS:
        q, r = np.linalg.qr(np.random.default_rng(SEED + size).normal(size=(size, size)))
        _ROTATIONS[size] = q * np.sign(np.diag(r))
    return _ROTATIONS[size]


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows at length 1 in double precision, whatever their scale."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign codes, packed, and correction factors of unit vectors."""
    turned = vectors @ rotation(vectors.shape[1])
    return np.packbits(turned >= 0, 1), np.abs(turned).sum(1) / np.sqrt(vectors.shape[1])


def candidates(code: np.ndarray, factor: np.ndarray, others: np.ndarray, least: float, spreads: float) -> np.ndarray:
    """Whether each vector behind a code may have a cosine of ``least`` or more with each of the unit vectors ``others``.

    At a true cosine c the estimate is off by sqrt(1 - c^2) times sqrt(1 - factor^2) / factor times a projection whose
    spread is 1 / sqrt(D - 1); from ``least`` on this only shrinks, so one limit per code holds for all that must be kept.
    """
    size = others.shape[1]
    signs = np.unpackbits(code, 1, size).astype(np.float32) * 2 - 1
    turned = (others @ rotation(size)).astype(np.float32)
    estimate = (signs / (factor[:, None] * np.sqrt(size)).astype(np.float32)) @ turned.T
    error = np.sqrt(np.maximum(0, 1 - factor**2)) / factor * np.sqrt(1 - least**2) * spreads / np.sqrt(max(size - 1, 1))
    return estimate >= (least - error - 1e-4).astype(np.float32)[:, None]


def usable(vector: Column) -> Column:
    """Whether a vector is not null, not zero and holds finite numbers only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def _coder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [np.asarray(v, np.float64) for v in batch.column(batch.schema.get_field_index("vector")).to_pylist()]
        codes, factors = [b""] * len(rows), np.zeros(len(rows))
        for size in {len(r) for r in rows}:
            at = [k for k, r in enumerate(rows) if len(r) == size]
            code, factor = encode(unit(np.stack([rows[k] for k in at])))
            factors[at] = factor
            for k, c in zip(at, code, strict=True):
                codes[k] = c.tobytes()
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.binary()), pa.array(factors)], [*batch.schema.names, "code", "factor"])


def _compare(least: float, spreads: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For every block pair: links of each vector counted by copies (b null), and pairs that join all that are linked."""

    def one(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rep, copies, block = (rows.column(c).to_numpy() for c in ("rep", "copies", "block"))
        same = rows.column("i")[0].as_py() == rows.column("j")[0].as_py()
        flat = rows.column("vector").combine_chunks()
        x = unit(flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rep), -1))
        left = np.arange(len(rep)) if same else np.flatnonzero(block == rows.column("i")[0].as_py())
        right = left if same else np.flatnonzero(block != rows.column("i")[0].as_py())
        if not len(left) or not len(right):
            return
        code = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(len(rep), -1)
        near = candidates(code[left], rows.column("factor").to_numpy()[left], x[right], least, spreads)
        a, b = np.nonzero(np.triu(near, 1) if same else near)
        a, b = left[a], right[b]
        linked = [a[:0]], [b[:0]]
        for k in range(0, len(a), PAIRS):
            p, q = a[k : k + PAIRS], b[k : k + PAIRS]
            ok = np.einsum("ij,ij->i", x[p], x[q]) >= least
            linked[0].append(p[ok])
            linked[1].append(q[ok])
        a, b = (np.concatenate(x) for x in linked)
        count = np.bincount(a, copies[b], len(rep)) + np.bincount(b, copies[a], len(rep))
        part = np.arange(len(rep))
        while True:
            low = np.minimum(part[a], part[b])
            new = part.copy()
            np.minimum.at(new, part[a], low)
            np.minimum.at(new, part[b], low)
            new = new[new]
            if (new == part).all():
                break
            part = new
        some, moved = np.flatnonzero(count), np.flatnonzero(part != np.arange(len(rep)))
        yield _links(rep[some], None, count[some].astype(np.int64))
        yield _links(rep[moved], rep[part[moved]], np.zeros(len(moved), np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["group", "i", "j"]):
            key = np.stack([table.column(c).to_numpy() for c in ("group", "i", "j")])
            heads = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(0)]))
            for low, high in zip(heads, [*heads[1:], table.num_rows], strict=True):
                yield from one(table.slice(low, high - low))

    return run


def _links(a: np.ndarray, b: np.ndarray | None, n: np.ndarray) -> pa.RecordBatch:
    other = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b)
    return pa.RecordBatch.from_arrays([pa.array(a), other, pa.array(n)], ["a", "b", "n"])


def near_duplicates(vectors: DataFrame, least: float, spreads: float = SPREADS) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of (vec_id, embedding, label).

    Two vectors are linked if their labels are equal and not null, their lengths are equal and their cosine in double
    precision is ``least`` or more. Null and zero vectors, and those that hold nulls or numbers that are not finite, are
    linked with nothing, and so is a row with a null id (its component is null). n_links counts other rows linked directly,
    copies among them; rows that repeat an id and its vector count as copies of each other.

    Copies become one class first. A label's classes are compared block against block in numpy, code against vector, and
    only counts and a spanning forest leave a task; the work on codes grows with the square of a label's distinct vectors.
    A pair at the threshold is missed if its estimate is off by more than ``spreads`` standard errors.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"), F.col("label").alias("label"))
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"))
    key = F.md5(F.concat_ws("|", F.col("label").cast("string"), F.array_join(F.col("vector").cast("array<string>"), ",")))
    rows = rows.withColumn("key", F.when(ok, key))
    group = F.xxhash64(F.col("label").cast("string"), F.size("vector"))
    whole = rows.where("key IS NOT NULL").groupBy("key").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.min("vector").alias("vector"), F.min(group).alias("group")
    )
    schema = f"rep long, copies long, vector {rows.schema['vector'].dataType.simpleString()}, group long, key string, code binary, factor double"
    coded = mapped(whole.select("rep", "copies", "vector", "group", "key"), _coder, schema)
    coded = session.materialise(coded, "codes")
    sizes = session.materialise(coded.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "sizes")
    placed = coded.drop("key").join(sizes, "group").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = [F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")]
    placed = placed.select("group", *pair, "rep", "copies", "vector", "code", "factor", "block")
    ranked = placed.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "rep")
    found = mapped(ranked, _compare(least, spreads), "a long, b long, n long")
    found = session.materialise(found, "links")
    counts = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("others"))
    parts = components(found.where("b IS NOT NULL").select("a", "b"))
    classes = coded.select("key", "rep", "copies").join(counts, F.col("rep") == F.col("a"), "left").drop("a")
    classes = classes.join(parts, F.col("rep") == F.col("node"), "left")
    classes = classes.select("key", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "rep").alias("least"))
    out = rows.select("vec_id", "key").join(classes, "key", "left")
    own = F.coalesce("least", "vec_id").alias("component_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), own).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )


LEAST = 0.93

SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {LEAST}),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least USING (vec_id) LEFT JOIN n USING (vec_id)
"""
