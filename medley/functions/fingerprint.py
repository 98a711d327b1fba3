"""The 64-bit Farm fingerprint of text, worked out for whole Arrow batches.

The public algorithm reads a text in one of five ways by its length in bytes; each is done at once for all texts of a
batch that it holds for. All arithmetic is unsigned and modulo 2^64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

U = np.uint64
# Fixed values of the algorithm.
K0, K1, K2 = U(0xC3A5C85C97CB3127), U(0xB492B66FBE98F273), U(0x9AE16A3B2F90404F)
SEED = 81
Pair = tuple[np.ndarray, np.ndarray]


def turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x >> U(by)) | (x << U(64 - by))


def fold(x: np.ndarray) -> np.ndarray:
    return x ^ (x >> U(47))


def mixed(u: np.ndarray, v: np.ndarray, by: np.ndarray) -> np.ndarray:
    a = fold((u ^ v) * by)
    return fold((v ^ a) * by) * by


class Texts:
    """Texts as bytes, and little-endian words at any place of them."""

    def __init__(self, data: bytes, start: np.ndarray, size: np.ndarray) -> None:
        self.start, self.size = start.astype(np.int64), size.astype(np.int64)
        held = np.frombuffer(data + bytes(8), np.uint8)
        self.bytes = held
        self.words = {n: np.ndarray((len(held) - n + 1,), f"<u{n}", held, strides=(1,)) for n in (4, 8)}

    def word(self, rows: np.ndarray, at: np.ndarray | int, width: int = 8) -> np.ndarray:
        return self.words[width][self.start[rows] + at].astype(U)


def brief(t: Texts, rows: np.ndarray) -> np.ndarray:
    """Texts of up to 16 bytes."""
    out, n = np.full(len(rows), K2), t.size[rows]
    for low, high in ((1, 3), (4, 7), (8, 16)):
        at = np.flatnonzero((n >= low) & (n <= high))
        r, size = rows[at], n[at]
        long = size.astype(U)
        by = K2 + long * U(2)
        if low == 8:
            a, b = t.word(r, 0) + K2, t.word(r, size - 8)
            out[at] = mixed(turn(b, 37) * by + a, (turn(a, 25) + b) * by, by)
        elif low == 4:
            out[at] = mixed(long + (t.word(r, 0, 4) << U(3)), t.word(r, size - 4, 4), by)
        else:
            one, mid, last = (t.bytes[t.start[r] + x].astype(U) for x in (0, size >> 1, size - 1))
            out[at] = fold((one + (mid << U(8))) * K2 ^ (long + (last << U(2))) * K0) * K2
    return out


def medium(t: Texts, rows: np.ndarray) -> np.ndarray:
    """Texts of 17 to 64 bytes; over 32 a second round takes in the middle."""
    n = t.size[rows]
    by, over = K2 + n.astype(U) * U(2), n > 32
    a, b = t.word(rows, 0) * np.where(over, K2, K1), t.word(rows, 8)
    c, d = t.word(rows, n - 8) * by, t.word(rows, n - 16) * K2
    y = turn(a + b, 43) + turn(c, 30) + d
    out = mixed(y, a + turn(b + K2, 18) + c, by)
    r = rows[over]
    by, y, z, a, n = by[over], y[over], out[over], a[over], n[over]
    e, f = t.word(r, 16) * by, t.word(r, 24)
    g, h = (y + t.word(r, n - 32)) * by, (z + t.word(r, n - 24)) * by
    out[over] = mixed(turn(e + f, 43) + turn(g, 30) + h, e + turn(f + a, 18) + g, by)
    return out


def long(t: Texts, rows: np.ndarray) -> np.ndarray:
    """Texts of more than 64 bytes, block by block of 64, all texts side by side; the last block ends with the text."""
    n = t.size[rows]
    blocks = (n - 1) // 64
    rows_left = np.argsort(-blocks, kind="stable")
    rows, n, blocks = rows[rows_left], n[rows_left], blocks[rows_left]

    def weak(r: np.ndarray, at: np.ndarray | int, a: np.ndarray, b: np.ndarray) -> Pair:
        w, x, y, z = (t.word(r, at + 8 * k) for k in range(4))
        a = a + w
        b = turn(b + a + z, 21)
        c = a
        a = a + x + y
        return a + z, b + turn(a, 44) + c

    def step(r: np.ndarray, at: np.ndarray | int, s: np.ndarray, by: np.ndarray | np.uint64, nine: int) -> np.ndarray:
        x, y, z, v0, v1, w0, w1 = s
        x = turn(x + y + v0 + t.word(r, at + 8), 37) * by
        y = turn(y + v1 + t.word(r, at + 48), 42) * by
        x = x ^ (w1 * U(nine))
        y = y + v0 * U(nine) + t.word(r, at + 40)
        z = turn(z + w0, 33) * by
        v0, v1 = weak(r, at, v1 * by, x + w0)
        w0, w1 = weak(r, at + 32, z + w1, y + t.word(r, at + 16))
        return np.stack([z, y, x, v0, v1, w0, w1])

    y = np.full(len(rows), U((SEED * int(K1) + 113) % (1 << 64)))
    z = fold(y * K2 + U(113)) * K2
    zero = np.zeros(len(rows), U)
    state = np.stack([U(SEED) * K2 + t.word(rows, 0), y, z, zero, zero, zero, zero])
    for k in range(int(blocks[0]) if len(rows) else 0):
        live = int(np.searchsorted(-blocks, -k, "left"))  # those with more than k whole blocks come first
        state[:, :live] = step(rows[:live], 64 * k, state[:, :live], K1, 1)
    rest = ((n - 1) & 63).astype(U)
    by = K1 + ((state[2] & U(0xFF)) << U(1))
    state[5] += rest
    state[3] += state[5]
    state[5] += state[3]
    x, y, z, v0, v1, w0, w1 = step(rows, n - 64, state, by, 9)
    found = mixed(mixed(v0, w0, by) + fold(y) * K0 + z, mixed(v1, w1, by) + x, by)
    out = np.empty(len(rows), U)
    out[rows_left] = found
    return out


def fingerprints(column: pa.Array) -> pa.Array:
    """The fingerprint of each text as a signed number; null stays null."""
    texts = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = (texts.buffers()[2] or b"")[offsets[0] : offsets[-1]] if len(texts) else b""
    t = Texts(bytes(data), offsets[:-1] - offsets[0], np.diff(offsets))
    out = np.empty(len(texts), U)
    with np.errstate(over="ignore"):
        for f, low, high in ((brief, 0, 16), (medium, 17, 64), (long, 65, None)):
            rows = np.flatnonzero((t.size >= low) & ((t.size <= high) if high else True))
            if len(rows):
                out[rows] = f(t, rows)
    return pa.array(out.view(np.int64), mask=column.is_null().to_numpy(zero_copy_only=False))


def farm(text: Column) -> Column:
    """[X18, K07] The Farm fingerprint of a text, as `farm_fingerprint` of warehouses gives it: a signed 64-bit number."""

    @F.arrow_udf("long")
    def of(column: pa.Array) -> pa.Array:
        return fingerprints(column)

    return of(text)
