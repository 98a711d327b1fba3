"""SentencePiece encoding and decoding in numpy.

An Aho-Corasick automaton over the pieces' bytes reads many words side by side, one byte a step. At each step the output
links of the state name every piece that ends there, the longest first, and each relaxes the best score of the position;
one pass gives the best segmentation.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medley.llm import base

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
NORMAL, UNKNOWN, USER_DEFINED, BYTE = 1, 2, 4, 6
UNKNOWN_PENALTY = 10.0
LONG = 64
CELLS = 1 << 18
SLICE = 1 << 19


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of every field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value, shift = 0, 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at : at + size]
        at += size


class Model:
    """Pieces with scores and kinds, and the few settings that matter, from a model file."""

    def __init__(self, data: bytes) -> None:
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.byte_fallback, self.dummy_prefix, self.one_space = False, True, True
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                self.pieces.append(own.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                self.kinds.append(own.get(3, NORMAL))
            elif number == 2:
                self.byte_fallback = bool(dict(_fields(value)).get(35, self.byte_fallback))
            elif number == 3:
                rules = dict(_fields(value))
                if rules.get(2):
                    raise ValueError("models that rewrite characters are not supported")
                self.dummy_prefix = bool(rules.get(3, 1))
                self.one_space = bool(rules.get(4, 1))
        self.digest = hashlib.sha256(data).hexdigest()

    @classmethod
    def load(cls, path: str) -> Model:
        return cls(Path(path).read_bytes())


class Automaton:
    """The pieces' trie with failure transitions filled in and output links."""

    def __init__(self, model: Model) -> None:
        own = [(p.encode(), i) for i, p in enumerate(model.pieces) if model.kinds[i] in (NORMAL, USER_DEFINED) and p]
        nodes: dict[tuple[int, int], int] = {}
        levels: list[list[tuple[int, int, int]]] = []
        ends: dict[int, int] = {}
        for text, piece in own:
            state = 0
            for depth, byte in enumerate(text):
                child = nodes.get((state, byte))
                if child is None:
                    child = nodes[state, byte] = len(nodes) + 1
                    if depth == len(levels):
                        levels.append([])
                    levels[depth].append((state, byte, child))
                state = child
            ends.setdefault(state, piece)
        n = len(nodes) + 1
        self.goto = np.zeros((n, 256), np.min_scalar_type(n))
        self.piece, self.length, self.score = np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n)
        for state, piece in ends.items():
            self.piece[state], self.length[state], self.score[state] = piece, len(model.pieces[piece].encode()), model.scores[piece]
        self.link = np.zeros(n, np.int32)
        fail = np.zeros(n, np.int32)
        for depth, level in enumerate(levels):
            parent, byte, child = (np.array(x) for x in zip(*level, strict=True))
            if depth:
                fail[child] = self.goto[fail[parent], byte]
            self.goto[parent, byte] = child
            self.goto[child] = self.goto[fail[child]]
            self.link[child] = np.where(self.piece[fail[child]] >= 0, fail[child], self.link[fail[child]])
        self.unknown = min([model.scores[i] for _, i in own], default=0.0) - UNKNOWN_PENALTY
        self.unknown_id = model.kinds.index(UNKNOWN) if UNKNOWN in model.kinds else 0
        found = {int(p[1:-1], 16): i for i, p in enumerate(model.pieces) if model.kinds[i] == BYTE}
        self.bytes = np.array([found[b] for b in range(256)], np.int32) if model.byte_fallback and len(found) == 256 else None
        # words may be cut apart where no piece reaches across: before a run of blanks, and around characters in no longer piece
        inside = {c for p, _ in own if len(p.decode()) > 1 for c in p.decode()}
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in inside)
        crossing = any(re.search(f"[^{BLANK}]{BLANK}", p.decode()) for p, _ in own)
        group = f"[{alone}]|" if alone else ""
        self.cut = re.compile("(?s).+" if crossing else f"(?s){group}{BLANK}*[^{BLANK}{alone}]+|{BLANK}+")

    def segment(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all words in a row, and how many each word has."""
        order = sorted(range(len(words)), key=lambda i: -len(words[i]))
        ids: list[np.ndarray | None] = [None] * len(words)
        at = 0
        while at < len(order):
            longest = len(words[order[at]])
            if longest > LONG:
                ids[order[at]] = self._one(words[order[at]])
                at += 1
                continue
            part = order[at : at + max(1, CELLS // max(1, longest))]
            for i, found in zip(part, self._many([words[i] for i in part]), strict=True):
                ids[i] = found
            at += len(part)
        return np.concatenate([np.zeros(0, np.int32), *ids]), np.array([len(x) for x in ids], np.int64)

    def _one(self, word: bytes) -> np.ndarray:
        """The same pass over one long word."""
        goto, link, length, score, piece = self.goto, self.link, self.length, self.score, self.piece
        best, back = [0.0] + [-np.inf] * len(word), [(0, 0)] * (len(word) + 1)
        state, head = 0, 0
        for t, byte in enumerate(word):
            if byte & 0xC0 != 0x80:
                head = t
            state = int(goto[state, byte])
            out = state if piece[state] >= 0 else int(link[state])
            single = False
            while out:
                n = int(length[out])
                single |= t + 1 - n == head
                value = best[t + 1 - n] + float(score[out])
                if value > best[t + 1]:
                    best[t + 1], back[t + 1] = value, (n, int(piece[out]))
                out = int(link[out])
            if not single and (t + 1 == len(word) or word[t + 1] & 0xC0 != 0x80) and best[head] + self.unknown > best[t + 1]:
                best[t + 1], back[t + 1] = best[head] + self.unknown, (t + 1 - head, -1)
        found: list[int] = []
        at = len(word)
        while at:
            n, own = back[at]
            found += [own] if own >= 0 else self._fallback(word[at - n : at])[::-1]
            at -= n
        return np.array(found[::-1], np.int32)

    def _fallback(self, char: bytes) -> list[int]:
        return [self.unknown_id] if self.bytes is None else [int(self.bytes[b]) for b in char]

    def _many(self, words: list[bytes]) -> list[np.ndarray]:
        """One pass over words side by side; they come longest first."""
        n, longest = len(words), len(words[0])
        size = np.array([len(w) for w in words])
        if not longest:
            return [np.zeros(0, np.int32)] * n
        text = np.zeros((n, longest + 1), np.uint8)
        text[np.arange(longest + 1) < size[:, None]] = np.frombuffer(b"".join(words), np.uint8)
        text = np.ascontiguousarray(text.T)
        best = np.full((longest + 1, n), -np.inf)
        best[0] = 0
        step, own = np.zeros((longest + 1, n), np.int32), np.zeros((longest + 1, n), np.int32)
        state, head = np.zeros(n, np.int32), np.zeros(n, np.int64)
        for t in range(longest):
            m = int(np.searchsorted(-size, -t, "left"))
            byte = text[t, :m]
            head[:m][(byte & 0xC0) != 0x80] = t
            s = self.goto[state[:m], byte]
            state[:m] = s
            out = np.where(self.piece[s] >= 0, s, self.link[s])
            single = np.zeros(m, bool)
            rows = np.flatnonzero(out)
            while len(rows):
                o = out[rows]
                length = self.length[o]
                single[rows] |= t + 1 - length == head[rows]
                value = best[t + 1 - length, rows] + self.score[o]
                ok = value > best[t + 1, rows]
                won = rows[ok]
                best[t + 1, won], step[t + 1, won], own[t + 1, won] = value[ok], length[ok], self.piece[o[ok]]
                out[rows] = self.link[o]
                rows = rows[out[rows] > 0]
            rows = np.flatnonzero(~single & (((text[t + 1, :m] & 0xC0) != 0x80) | (size[:m] == t + 1)))
            if len(rows):
                value = best[head[rows], rows] + self.unknown
                ok = value > best[t + 1, rows]
                won = rows[ok]
                best[t + 1, won], step[t + 1, won], own[t + 1, won] = value[ok], t + 1 - head[won], -1
        at, rows, parts = size.copy(), np.flatnonzero(size), []
        while len(rows):
            length, piece = step[at[rows], rows], own[at[rows], rows]
            parts.append((rows, at[rows] - length, length, piece))
            at[rows] -= length
            rows = rows[at[rows] > 0]
        word, start, length, piece = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((start, word))
        word, start, length, piece = word[order], start[order], length[order], piece[order]
        plain = piece >= 0
        count = np.where(plain | (self.bytes is None), 1, length)
        flat, begin = np.repeat(piece, count), np.cumsum(count) - count
        if self.bytes is None:
            flat[flat < 0] = self.unknown_id
        else:
            lost = np.repeat(~plain, count)
            where = np.repeat(start - begin, count) + np.arange(len(flat))
            flat[lost] = self.bytes[text[where[lost], np.repeat(word, count)[lost]]]
        return np.split(flat.astype(np.int32), np.cumsum(np.bincount(word, count, n).astype(np.int64))[:-1])


_AUTOMATA: dict[str, Automaton] = {}


def automaton(model: Model) -> Automaton:
    """The model's automaton, built once in each worker."""
    if model.digest not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[model.digest] = Automaton(model)
    return _AUTOMATA[model.digest]


def normalise(model: Model, text: str) -> str:
    """Blanks for spaces and, where the model asks for it, one blank before the text and no repeated spaces."""
    if model.one_space:
        text = re.sub(" +", " ", text.strip(" "))
    if model.dummy_prefix and text:
        text = " " + text
    return text.replace(" ", BLANK)


def encode_texts(model: Model, texts: list[str]) -> Iterator[np.ndarray]:
    """Piece ids of every text; each distinct word of about SLICE characters of text is segmented once."""
    machine = automaton(model)
    low = 0
    while low < len(texts):
        high, size = low, 0
        index: dict[str, int] = {}
        words: list[int] = []
        count: list[int] = []
        while high < len(texts) and (high == low or size + len(texts[high]) <= SLICE):
            found = machine.cut.findall(normalise(model, texts[high]))
            words += [index.setdefault(w, len(index)) for w in found]
            count.append(len(found))
            size += len(texts[high])
            high += 1
        flat, n = machine.segment([w.encode("utf-8", "replace") for w in index])
        which = np.array(words, np.int64)
        lengths = n[which]
        ends = np.cumsum(lengths)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat((np.cumsum(n) - n)[which] - (ends - lengths), lengths)
        ids = flat[at]
        stops = np.concatenate([[0], ends])[np.cumsum(count)]
        yield from np.split(ids, stops[:-1])
        low = high


def decode_ids(model: Model, ids: list[np.ndarray]) -> Iterator[str]:
    """The normalised text with spaces for blanks and without the blank before it; control pieces are silent.

    Byte pieces that make no valid character give replacement characters; an id outside the vocabulary is an error.
    """
    table = []
    for piece, kind in zip(model.pieces, model.kinds, strict=True):
        if kind == BYTE:
            table.append(bytes([int(piece[1:-1], 16)]))
        else:
            table.append(piece.replace(BLANK, " ").encode() if kind in (NORMAL, USER_DEFINED) else b" \xe2\x81\x87 " if kind == UNKNOWN else b"")
    for row in ids:
        if len(row) and (row.min() < 0 or row.max() >= len(table)):
            raise ValueError("an id is outside the vocabulary")
        text = b"".join([table[i] for i in row.tolist()]).decode("utf-8", "replace")
        yield text[1:] if model.dummy_prefix and text.startswith(" ") else text


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *rows]), pa.int32()))


def encode(docs: DataFrame, path: str = MODEL, text: str = "text") -> DataFrame:
    """Every row with n_tokens and token_ids; input columns of these names are replaced. Null and empty texts have no token.

    The model file is read by the driver and its pieces travel with the job. Pieces' scores are summed whatever the
    file's own algorithm, so a merge-ranked vocabulary gives the segmentation of best total score, not that of its merges.
    """
    model = Model.load(path)

    def compute(texts: pa.Array) -> list[pa.Array]:
        rows = list(encode_texts(model, [t or "" for t in texts.to_pylist()]))
        return [pa.array([len(r) for r in rows], pa.int32()), _lists(rows)]

    return base.annotate(docs, text, {"n_tokens": T.IntegerType(), "token_ids": T.ArrayType(T.IntegerType())}, compute)


def decode(rows: DataFrame, path: str = MODEL) -> DataFrame:
    """Every row with decoded, the text that its token_ids stand for (null for null); an input column of this name is replaced."""
    model = Model.load(path)

    def compute(lists: pa.Array) -> list[pa.Array]:
        found = decode_ids(model, [np.zeros(0, np.int32) if not x.is_valid else x.values.to_numpy() for x in lists])
        return [pa.array([t if x.is_valid else None for t, x in zip(found, lists, strict=True)], pa.string())]

    return base.annotate(rows, "token_ids", {"decoded": T.StringType()}, compute)


def round_trip(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, token_ids, decoded_sha256 and whether decoding gives the text back, of every row.

    A null text counts as empty. Texts that the model's own normalisation changes (repeated spaces, where it drops them)
    come back normalised and are marked false. Encoding and decoding share one pass, so a core needs one Python worker.
    """
    model = Model.load(path)

    def compute(texts: pa.Array) -> list[pa.Array]:
        own = [t or "" for t in texts.to_pylist()]
        rows = list(encode_texts(model, own))
        back = list(decode_ids(model, rows))
        digest = [hashlib.sha256(t.encode()).hexdigest() for t in back]
        same = [a == b for a, b in zip(own, back, strict=True)]
        return [pa.array([len(r) for r in rows], pa.int32()), _lists(rows), pa.array(digest, pa.string()), pa.array(same, pa.bool_())]

    added = {"n_tokens": T.IntegerType(), "token_ids": T.ArrayType(T.IntegerType()), "decoded_sha256": T.StringType(), "round_trip": T.BooleanType()}
    rows = base.annotate(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "text", added, compute)
    return rows.select("doc_id", *added)
