"""Published values, and a plain reading of the public algorithm, one text at a time."""

import struct

import pyarrow as pa
import pytest

from medley.functions import fingerprint

M = (1 << 64) - 1
K0, K1, K2 = 0xC3A5C85C97CB3127, 0xB492B66FBE98F273, 0x9AE16A3B2F90404F
# Published fingerprints.
PUBLISHED = {
    "": -7286425919675154353, "test": 8581389452482819506, "test" * 8: -4196240717365766262, "test" * 64: 3500507768004279527,
    "1footrue": -1541654101129638711, "2applefalse": 2794438866806483259, "3true": -4880158226897771312,
}


def rot(x, k):
    return ((x >> k) | (x << (64 - k))) & M


def sm(x):
    return x ^ (x >> 47)


def h16(u, v, m):
    a = sm((u ^ v) * m & M)
    return sm((v ^ a) * m & M) * m & M


def plain(s):
    n = len(s)
    f8 = lambda i: struct.unpack_from("<Q", s, i)[0]
    f4 = lambda i: struct.unpack_from("<I", s, i)[0]
    mul = (K2 + 2 * n) & M
    if n == 0:
        return K2
    if n < 4:
        return sm(((s[0] + (s[n >> 1] << 8)) * K2 & M) ^ ((n + (s[-1] << 2)) * K0 & M)) * K2 & M
    if n < 8:
        return h16(n + (f4(0) << 3), f4(n - 4), mul)
    if n <= 16:
        a, b = (f8(0) + K2) & M, f8(n - 8)
        return h16((rot(b, 37) * mul + a) & M, (rot(a, 25) + b) * mul & M, mul)
    if n <= 64:
        a, b, c, d = f8(0) * (K1 if n <= 32 else K2) & M, f8(8), f8(n - 8) * mul & M, f8(n - 16) * K2 & M
        y = (rot((a + b) & M, 43) + rot(c, 30) + d) & M
        z = h16(y, (a + rot((b + K2) & M, 18) + c) & M, mul)
        if n <= 32:
            return z
        e, f, g, h = f8(16) * mul & M, f8(24), (y + f8(n - 32)) * mul & M, (z + f8(n - 24)) * mul & M
        return h16((rot((e + f) & M, 43) + rot(g, 30) + h) & M, (e + rot((f + a) & M, 18) + g) & M, mul)

    def weak(i, a, b):
        w, x, y, z = (f8(i + 8 * k) for k in range(4))
        a = (a + w) & M
        b = rot((b + a + z) & M, 21)
        c = a
        a = (a + x + y) & M
        return (a + z) & M, (b + rot(a, 44) + c) & M

    x, y = 81, (81 * K1 + 113) & M
    z, v, w = sm((y * K2 + 113) & M) * K2 & M, (0, 0), (0, 0)
    x = (x * K2 + f8(0)) & M
    i, end = 0, (n - 1) // 64 * 64
    while i != end:
        x = rot((x + y + v[0] + f8(i + 8)) & M, 37) * K1 & M
        y = rot((y + v[1] + f8(i + 48)) & M, 42) * K1 & M
        x ^= w[1]
        y = (y + v[0] + f8(i + 40)) & M
        z = rot((z + w[0]) & M, 33) * K1 & M
        v = weak(i, v[1] * K1 & M, (x + w[0]) & M)
        w = weak(i + 32, (z + w[1]) & M, (y + f8(i + 16)) & M)
        z, x, i = x, z, i + 64
    mul, i = (K1 + ((z & 0xFF) << 1)) & M, n - 64
    w = ((w[0] + ((n - 1) & 63)) & M, w[1])
    v = ((v[0] + w[0]) & M, v[1])
    w = ((w[0] + v[0]) & M, w[1])
    x = rot((x + y + v[0] + f8(i + 8)) & M, 37) * mul & M
    y = rot((y + v[1] + f8(i + 48)) & M, 42) * mul & M
    x ^= w[1] * 9 & M
    y = (y + v[0] * 9 + f8(i + 40)) & M
    z = rot((z + w[0]) & M, 33) * mul & M
    v = weak(i, v[1] * mul & M, (x + w[0]) & M)
    w = weak(i + 32, (z + w[1]) & M, (y + f8(i + 16)) & M)
    z, x = x, z
    return h16((h16(v[0], w[0], mul) + sm(y) * K0 + z) & M, (h16(v[1], w[1], mul) + x) & M, mul)


def test_published_values():
    assert fingerprint.fingerprints(pa.array(list(PUBLISHED))).to_pylist() == list(PUBLISHED.values())


@pytest.mark.parametrize("cut", [0, 3])
def test_every_length_against_the_plain_form(cut):
    texts = ["".join(chr(33 + (i * i + 7 * n) % 90) for i in range(n)) for n in range(400)] + ["größe " * 50, "ü"]
    signed = [x - (1 << 64) if x >> 63 else x for x in (plain(t.encode()) for t in texts)]
    assert fingerprint.fingerprints(pa.array(texts).slice(cut)).to_pylist() == signed[cut:]


def test_as_a_column(spark, same):
    rows = spark.createDataFrame([(1, "test"), (2, None), (3, "")], "id int, t string")
    same(rows.select("id", fingerprint.farm(rows["t"]).alias("h")), [(1, PUBLISHED["test"]), (2, None), (3, PUBLISHED[""])])
    assert rows.limit(0).select(fingerprint.farm(rows["t"])).count() == 0
