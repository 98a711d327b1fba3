"""Plain versions of the pair operators."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingles(text, size):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def near_groups(rows, size, percent):
    """doc_id -> (set size, least id linked), by comparing every pair."""
    sets = {i: shingles(t, size) for i, t in rows}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    parts = union_find(sets, links)
    return {i: (len(sets[i]), parts[i]) for i in sets}


def without_repeats(rows, window):
    """doc_id -> (words, removed, kept text), window by window."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            if key in seen:
                gone[p : p + window] = [True] * window
            seen.add(key)
        out[i] = (len(words), sum(gone), " ".join(w for w, g in zip(words, gone, strict=True) if not g))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
