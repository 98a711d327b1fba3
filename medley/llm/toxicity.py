"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is the embedding of its hash next to the greatest values of its character trigrams' embeddings. Two gated recurrent
layers, one from either side, read windows of 32 words that overlap by half and cover the whole text; attention pools a
window's states into one log-odds, and a document's score is that of its worst window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medley.llm import base, words

WINDOW, HOP = 32, 16
BUCKETS = 1 << 12
EMBED, HIDDEN = 8, 12
SAMPLE = 1500
PIECE = 1 << 18
BATCH = 2048
THRESHOLD = 0.3
PASSES, STEPS = 6, 500
DECAY = 0.5

Net = dict[str, np.ndarray]


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes with ASCII punctuation blanked, and row, start and end of each word in them."""
    data = words.lower_ascii(data)
    letter = (data >= 128) | ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57))
    data = np.where(letter, data, np.uint8(32))
    return data, *words.spans(data, offsets)


def vocabulary(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Index of each word among the distinct ones; bucket of each distinct word; its trigrams' buckets, flat, and counts.

    Trigrams run over the bytes of the word with a blank before and after it.
    """
    hashed, first, index = np.unique(words.hashes(data, start, end), return_index=True, return_inverse=True)
    bucket = (hashed % np.uint64(BUCKETS)).astype(np.int64)
    s, e = start[first], end[first]
    size = e - s
    which = np.repeat(np.arange(len(s)), size)
    at = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(s, size)
    left = np.where(at > s[which], data[np.maximum(at - 1, 0)], 32).astype(np.uint64)
    right = np.where(at + 1 < e[which], data[np.minimum(at + 1, len(data) - 1)], 32).astype(np.uint64)
    code = (left << np.uint64(16)) | (data[at].astype(np.uint64) << np.uint64(8)) | right
    return index, bucket, (words.mix(code) % np.uint64(BUCKETS)).astype(np.int64), size


def windows(row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the words of every window (-1 beyond the text) and each window's row; a row without words has one."""
    count = np.bincount(row, minlength=rows)
    first = np.cumsum(count) - count
    n = np.maximum(1, -(-(count - (WINDOW - HOP)) // HOP))
    doc = np.repeat(np.arange(rows), n)
    local = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * HOP
    at = local[:, None] + np.arange(WINDOW)
    return np.where(at < count[doc][:, None], at + first[doc][:, None], -1), doc


def new_net(seed: int) -> Net:
    rng = np.random.default_rng(seed)
    x, h = 2 * EMBED, HIDDEN
    net = {"word": rng.normal(0, 0.02, (BUCKETS, EMBED)), "tri": rng.normal(0, 0.02, (BUCKETS, EMBED))}
    for side in "fb":
        net |= {f"w{side}": rng.normal(0, x**-0.5, (x, 3 * h)), f"u{side}": rng.normal(0, h**-0.5, (h, 3 * h)), f"b{side}": np.zeros(3 * h)}
    net |= {"a": rng.normal(0, 0.3, (2 * h, 2 * h)), "v": rng.normal(0, 0.3, 2 * h), "o": rng.normal(0, 0.3, 2 * h), "c": np.zeros(1)}
    return {k: v.astype(np.float32) for k, v in net.items()}


def inputs(net: Net, bucket: np.ndarray, tri: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Input vector of each distinct word."""
    chars = np.maximum.reduceat(net["tri"][tri], np.cumsum(size) - size) if len(size) else np.zeros((0, EMBED), np.float32)
    return np.hstack([net["word"][bucket], chars])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _run(net: Net, side: str, proj: np.ndarray, ids: np.ndarray, keep: list | None) -> np.ndarray:
    """States of one direction, shaped (time, window, HIDDEN). A place beyond the text leaves the state as it was."""
    h, u = HIDDEN, net[f"u{side}"]
    state = np.zeros((len(ids), h), np.float32)
    out = np.empty((WINDOW, len(ids), h), np.float32)
    for t in range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1):
        x, real = proj[ids[:, t]], (ids[:, t] >= 0)[:, None]
        gates = _sigmoid(x[:, : 2 * h] + state @ u[:, : 2 * h])
        z, r = gates[:, :h], gates[:, h:]
        n = np.tanh(x[:, 2 * h :] + (r * state) @ u[:, 2 * h :])
        z = np.where(real, z, np.float32(1))
        new = z * state + (1 - z) * n
        if keep is not None:
            keep.append((t, state, z, r, n, real))
        out[t] = state = new
    return out


def forward(net: Net, x: np.ndarray, ids: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Log-odds of each window; ``ids`` index the rows of ``x``, -1 is beyond the text."""
    saved: dict[str, list] = {"f": [], "b": []}
    both = []
    for side in "fb":
        proj = np.vstack([x @ net[f"w{side}"] + net[f"b{side}"], np.zeros((1, 3 * HIDDEN), np.float32)])
        both.append(_run(net, side, proj, ids, saved[side] if keep is not None else None))
    states = np.concatenate(both, 2)
    act = np.tanh(states @ net["a"])
    weight = act @ net["v"] + np.where(ids.T >= 0, 0, -1e4).astype(np.float32)
    weight = np.exp(weight - weight.max(0))
    weight /= weight.sum(0)
    pooled = np.einsum("tn,tnk->nk", weight, states)
    if keep is not None:
        keep |= {"saved": saved, "states": states, "act": act, "weight": weight, "pooled": pooled}
    return pooled @ net["o"] + net["c"][0]


def backward(net: Net, x: np.ndarray, ids: np.ndarray, keep: dict, g: np.ndarray) -> tuple[Net, np.ndarray]:
    """Gradients of the weights and of the input vectors, given those of the windows' log-odds."""
    h = HIDDEN
    states, act, weight, pooled = (keep[k] for k in ("states", "act", "weight", "pooled"))
    grads = {"o": pooled.T @ g, "c": np.array([g.sum()], np.float32)}
    into = g[:, None] * net["o"]
    d_weight = np.einsum("nk,tnk->tn", into, states)
    d_score = weight * (d_weight - (weight * d_weight).sum(0))
    d_act = d_score[:, :, None] * net["v"] * (1 - act * act)
    grads["v"] = np.einsum("tn,tnk->k", d_score, act)
    grads["a"] = np.einsum("tni,tnj->ij", states, d_act)
    d_states = weight[:, :, None] * into + d_act @ net["a"].T
    d_x = np.zeros_like(x)
    for k, side in enumerate("fb"):
        u, w = net[f"u{side}"], net[f"w{side}"]
        d_u, d_w, d_b = np.zeros_like(u), np.zeros_like(w), np.zeros(3 * h, np.float32)
        flow = np.zeros((len(ids), h), np.float32)
        for t, state, z, r, n, real in reversed(keep["saved"][side]):
            flow = flow + d_states[t, :, k * h : (k + 1) * h]
            d_n = flow * (1 - z) * (1 - n * n)
            d_z = np.where(real, flow * (state - n) * z * (1 - z), 0)
            d_rs = d_n @ u[:, 2 * h :].T
            d_r = d_rs * state * r * (1 - r)
            d_gate = np.hstack([d_z, d_r])
            d_u[:, : 2 * h] += state.T @ d_gate
            d_u[:, 2 * h :] += (r * state).T @ d_n
            flow = flow * z + d_rs * r + d_gate @ u[:, : 2 * h].T
            d_all = np.hstack([d_gate, d_n])
            there = real[:, 0]
            at = ids[there, t]
            d_w += x[at].T @ d_all[there]
            d_b += d_all[there].sum(0)
            np.add.at(d_x, at, d_all[there] @ w.T)
        grads |= {f"u{side}": d_u, f"w{side}": d_w, f"b{side}": d_b}
    return grads, d_x


def _spread(net: Net, bucket: np.ndarray, tri: np.ndarray, size: np.ndarray, d_x: np.ndarray) -> Net:
    word, chars = np.zeros_like(net["word"]), np.zeros_like(net["tri"])
    np.add.at(word, bucket, d_x[:, :EMBED])
    each = net["tri"][tri]
    won = each == np.repeat(np.maximum.reduceat(each, np.cumsum(size) - size), size, 0)
    np.add.at(chars, tri, np.repeat(d_x[:, EMBED:], size, 0) * won)
    return {"word": word, "tri": chars}


def learn(texts: list[str], labels: list[int], passes: int = PASSES, steps: int = STEPS, seed: int = 3) -> Net:
    """Fit by Adam: in a third of the passes all windows carry their text's label, then each text is judged by its worst windows.

    Few texts are gone through more often, up to about ``steps`` steps.
    """
    net, rng = new_net(seed), np.random.default_rng(seed)
    y = np.asarray(labels, np.float32)
    if len(set(labels)) < 2:
        net["o"][:] = 0
        net["c"][:] = (4 if labels[0] else -4) if labels else 0
        return net
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in raw])])
    data, row, start, end = tokens(np.frombuffer(b"".join(raw), np.uint8), offsets)
    index, bucket, tri, size = vocabulary(data, start, end)
    first = np.cumsum(size) - size
    at, doc = windows(row, len(texts))
    ids = np.where(at >= 0, index[at], -1) if len(index) else at
    state: dict = {}
    passes = max(passes, -(-steps // max(1, len(texts) * 5 // 256)))
    for turn in range(passes):
        if turn < passes // 3:
            chosen = rng.permutation(len(ids))
        else:
            x = inputs(net, bucket, tri, size)
            odds = np.concatenate([forward(net, x, ids[k : k + BATCH]) for k in range(0, len(ids), BATCH)])
            order = np.lexsort((-odds, doc))
            rank = np.arange(len(order)) - np.searchsorted(doc[order], doc[order], "left")
            chosen = rng.permutation(order[rank < np.where(y[doc[order]] > 0, 1, 2)])
        for low in range(0, len(chosen), 256):
            part = chosen[low : low + 256]
            used, local = np.unique(ids[part], return_inverse=True)
            local = local.reshape(len(part), WINDOW) - int(len(used) > 0 and used[0] < 0)
            used = used[used >= 0]
            if not len(used):
                continue
            t = np.concatenate([tri[first[k] : first[k] + size[k]] for k in used])
            # half of the distinct words are seen by their letters only, so that letters come to matter
            shown = (rng.random(len(used)) < 0.5)[:, None]
            x = inputs(net, bucket[used], t, size[used])
            x[:, :EMBED] *= shown
            keep: dict = {}
            odds = forward(net, x, local, keep)
            g = ((1 / (1 + np.exp(-np.clip(odds, -30, 30))) - y[doc[part]]) / len(part)).astype(np.float32)
            grads, d_x = backward(net, x, local, keep, g)
            d_x[:, :EMBED] *= shown
            _adam(net, grads | _spread(net, bucket[used], t, size[used], d_x), state, 0.01 if turn < passes * 2 // 3 else 0.004)
    return net


def _adam(net: Net, grads: Net, state: dict, rate: float) -> None:
    step = state["step"] = state.get("step", 0) + 1
    for k, g in grads.items():
        m, v = state.setdefault(k, (np.zeros_like(net[k]), np.zeros_like(net[k])))
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        net[k] -= rate * ((m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) + (DECAY * net[k] if k in ("word", "tri") else 0))


def probability(net: Net, data: np.ndarray, offsets: np.ndarray, shift: float = 0.0) -> np.ndarray:
    """Probability of label 1 of every text: that of its worst window."""
    rows = len(offsets) - 1
    if rows < 1:
        return np.zeros(0)
    data, row, start, end = tokens(data, offsets)
    index, bucket, tri, size = vocabulary(data, start, end)
    x = inputs(net, bucket, tri, size)
    at, doc = windows(row, rows)
    ids = np.where(at >= 0, index[at], -1) if len(index) else at
    odds = np.concatenate([forward(net, x, ids[k : k + BATCH]) for k in range(0, len(ids), BATCH)]).astype(np.float64)
    worst = np.maximum.reduceat(odds, np.searchsorted(doc, np.arange(rows))) + shift
    return 1 / (1 + np.exp(-np.clip(worst, -40, 40)))


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, by a network fitted to ``labels`` (doc_id, toxic).

    About ``sample`` whole documents of each label, none of them held out, are learned from, and the log-odds are then moved to
    the labels' own shares among all rows that are not held out; every window of every whole text is scored. Null and
    empty texts are scored as one empty window; equal texts have equal scores. Repeated ids each get a row. Without any
    usable label the score is 0.5, with one label value it is nearly that value.
    """
    rows = base.training_sample(docs, labels.select("doc_id", F.col("toxic").alias("label")), sample, "toxic", None)
    rows = rows.orderBy("doc_id", "text").toPandas()
    net = learn(rows["text"].tolist(), rows["label"].astype(int).tolist())
    shift = base.prior_shift(labels, "toxic", rows["label"])

    def compute(texts: pa.Array) -> list[pa.Array]:
        data, offsets = words.buffers(texts)
        cut = words.slices(offsets, PIECE)
        found = [probability(net, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], shift) for a, b in cut]
        p = np.concatenate([np.zeros(0), *found])
        return [pa.array(p), pa.array((p >= threshold).astype(np.int32), pa.int32())]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), base.held_out().alias("held_out"), "text")
    scored = base.annotate(rows, "text", {"score": T.DoubleType(), "predicted": T.IntegerType()}, compute)
    return scored.select("doc_id", "held_out", "score", "predicted")
