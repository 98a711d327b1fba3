"""Document quality by a byte-level convolutional network in numpy.

Bytes are embedded; filters 8 bytes wide slide by 4 bytes; their rectified outputs are max-pooled within chunks of 512
bytes that overlap by half and cover the whole text; a document's features are the greatest and the mean of its chunks'
outputs, and one logistic unit makes a probability of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medley.llm import base, words

PAD = 256
HOP, CHUNK = 256, 512
STRIDE = 4
EMBED, FILTERS = 8, 32
BLOCKS = HOP // STRIDE
SAMPLE = 1200
EPOCHS, STEPS = 16, 1200
PIECE = 1 << 17
THRESHOLD = 0.7


@dataclass
class Net:
    """Weights. ``conv`` maps two neighbouring blocks of four embedded bytes to the filters' outputs."""

    embed: np.ndarray
    conv: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.conv, self.bias, self.out, self.out_bias]


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ids with every document padded to whole half-chunks, one chunk at least; half-chunks of each document."""
    length = np.diff(offsets)
    halves = np.maximum(2, -(-length // HOP))
    begins = np.concatenate([[0], np.cumsum(halves * HOP)])
    ids = np.full(begins[-1], PAD, np.int64)
    ids[np.arange(len(data)) + np.repeat(begins[:-1] - offsets[:-1], length)] = data
    return ids, halves


def chunk_outputs(net: Net, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each half-chunk: the greatest output of the positions that end in it, and of all that begin in it."""
    x = net.embed[ids].reshape(-1, STRIDE * EMBED)
    width = STRIDE * EMBED
    y = x @ net.conv[:width]
    y[:-1] += x[1:] @ net.conv[width:]
    y = y.reshape(-1, BLOCKS, FILTERS)
    inner = y[:, :-1].max(1)
    whole = np.maximum(inner, y[:, -1])
    return np.maximum(inner + net.bias, 0), np.maximum(whole + net.bias, 0)


def features(net: Net, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Greatest and mean chunk output of every document, over pieces of bounded size."""
    ids, halves = padded(data, offsets)
    inner, whole = (np.concatenate(p) for p in zip(*_pieces(net, ids), strict=True))
    chunk = np.maximum(whole[:-1], inner[1:])
    ends = np.cumsum(halves)
    real = np.ones(len(whole), bool)
    real[ends - 1] = False  # a document's last half-chunk begins no chunk
    chunk = chunk[real[:-1]]
    starts = np.concatenate([[0], np.cumsum(halves - 1)[:-1]])
    return np.hstack([np.maximum.reduceat(chunk, starts), np.add.reduceat(chunk, starts) / (halves - 1)[:, None]])


def _pieces(net: Net, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    # a position at the end of a piece reaches into the next one, so each piece is given one more half-chunk
    for low in range(0, len(ids), PIECE):
        high = min(low + PIECE, len(ids))
        more = min(high + HOP, len(ids))
        inner, whole = chunk_outputs(net, ids[low:more])
        yield inner[: (high - low) // HOP], whole[: (high - low) // HOP]


def probability(net: Net, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probability of label 1 of every document."""
    if len(offsets) < 2:
        return np.zeros(0)
    z = features(net, data, offsets).astype(np.float64) @ net.out.astype(np.float64) + float(net.out_bias[0])
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _adam(params: list[np.ndarray], grads: list[np.ndarray], state: list, rate: float) -> None:
    if not state:
        state += [[np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0]
    state[2] += 1
    for p, g, m, v in zip(params, grads, state[0], state[1], strict=True):
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        p -= rate * (m / (1 - 0.9 ** state[2])) / (np.sqrt(v / (1 - 0.999 ** state[2])) + 1e-8)


def learn(texts: list[str], labels: list[int], epochs: int = EPOCHS, steps: int = STEPS, seed: int = 7) -> Net:
    """Fit the network by Adam on log loss; the gradient of a pooled maximum goes to the position that won."""
    rng = np.random.default_rng(seed)
    net = Net(
        rng.normal(0, 0.5, (257, EMBED)).astype(np.float32),
        rng.normal(0, (2 * STRIDE * EMBED) ** -0.5, (2 * STRIDE * EMBED, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        np.zeros(1, np.float32),
    )
    y = np.asarray(labels, np.float32)
    state: list = []
    raw = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    batches = -(-len(raw) // 32)
    epochs = max(epochs, -(-steps // max(1, batches)))  # few texts are gone through more often
    for epoch in range(epochs if len(set(labels)) > 1 else 0):
        order = rng.permutation(len(raw))
        for low in range(0, len(order), 32):
            rows = order[low : low + 32]
            data, offsets = np.concatenate([raw[i] for i in rows]), np.concatenate([[0], np.cumsum([len(raw[i]) for i in rows])])
            _adam(net.parts(), _gradients(net, data, offsets, y[rows]), state, 0.004 if epoch < epochs // 2 else 0.001)
    if len(set(labels)) == 1:
        net.out[:] = 0
        net.out_bias[:] = 4 if labels[0] else -4
    return net


def _gradients(net: Net, data: np.ndarray, offsets: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    ids, halves = padded(data, offsets)
    n, width = len(halves), STRIDE * EMBED
    heads = np.concatenate([np.arange(h - 1) for h in halves]) + np.repeat(np.cumsum(halves) - halves, halves - 1)
    doc = np.repeat(np.arange(n), halves - 1)
    chunk_ids = ids.reshape(-1, HOP)[heads[:, None] + np.arange(2)].reshape(-1, CHUNK)
    x = net.embed[chunk_ids].reshape(len(doc), 2 * BLOCKS, width)
    y_all = x[:, :-1] @ net.conv[:width] + x[:, 1:] @ net.conv[width:]
    at = y_all.argmax(1)
    pooled = np.maximum(np.take_along_axis(y_all, at[:, None], 1)[:, 0] + net.bias, 0)
    count = (halves - 1).astype(np.float32)
    starts = np.concatenate([[0], np.cumsum(halves - 1)[:-1]])
    top = np.maximum.reduceat(pooled, starts)
    f = np.hstack([top, np.add.reduceat(pooled, starts) / count[:, None]])
    z = f @ net.out + net.out_bias[0]
    g = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n).astype(np.float32)
    back = g[:, None] * net.out
    won = pooled == top[doc]
    grad = (back[:, :FILTERS][doc] * won / np.maximum(np.add.reduceat(won, starts)[doc], 1) + (back[:, FILTERS:] / count[:, None])[doc]) * (pooled > 0)
    rows, cols = np.nonzero(grad)
    values = grad[rows, cols].astype(np.float32)
    where = at[rows, cols] * STRIDE
    ids_won = chunk_ids[rows[:, None], where[:, None] + np.arange(2 * STRIDE)]
    patches = net.embed[ids_won].reshape(len(rows), 2 * width)
    conv = np.zeros_like(net.conv)
    np.add.at(conv.T, cols, patches * values[:, None])
    into = (net.conv.T[cols] * values[:, None]).reshape(-1, EMBED)
    embed = np.zeros_like(net.embed)
    np.add.at(embed, ids_won.reshape(-1), into)
    return [embed, conv, grad.sum(0), f.T @ g, np.array([g.sum()], np.float32)]


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """Every row with score and predicted, by a network fitted to ``labels`` (doc_id, quality).

    About ``sample`` whole documents of each label, none of them held out, are learned from, and the probability is then moved
    to the labels' own shares among all rows that are not held out; every whole text is scored. Null and empty texts are
    scored as one padded chunk; equal texts have equal scores. Repeated ids and null ids each get a score. Without any
    usable label the score is 0.5, with one label value it is nearly that value. Input columns of these names are replaced.
    """
    rows = base.training_sample(docs, labels.select("doc_id", F.col("quality").alias("label")), sample, "quality", None)
    rows = rows.orderBy("doc_id", "text").toPandas()
    net = learn(rows["text"].tolist(), rows["label"].astype(int).tolist())
    if not len(rows):
        net.out[:] = 0
    net.out_bias += base.prior_shift(labels, "quality", rows["label"])

    def compute(texts: pa.Array) -> list[pa.Array]:
        data, offsets = words.buffers(texts)
        found = [probability(net, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in words.slices(offsets)]
        p = np.concatenate([np.zeros(0), *found])
        return [pa.array(p), pa.array((p >= threshold).astype(np.int32), pa.int32())]

    return base.annotate(docs, "text", {"score": T.DoubleType(), "predicted": T.IntegerType()}, compute)


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, as ``judge`` finds them."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), base.held_out().alias("held_out"), "text")
    return judge(rows, labels, sample, threshold).select("doc_id", "held_out", "score", "predicted")
