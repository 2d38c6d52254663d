"""Plain versions of the operators, for small fixtures."""

from __future__ import annotations

import hashlib
from collections import Counter

CLASHING = "doc_id long, text string, row string, rid string, n string, sig string, mark string, key string, score string, part string"


def documents(spark, texts, ids=None):
    """A table with the given texts and more columns than needed."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, *"abcdefgh") for i, t in zip(ids, texts, strict=True)], CLASHING)


def shingles(text, k):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def jaccard_classes(texts, k, percent):
    """(n_shingles, component) of each text, ids being positions; compares all pairs."""
    sets = [shingles(t, k) for t in texts]
    least = list(range(len(texts)))

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                least[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def without_repeats(texts, length):
    """(bytes, removed, spans, hash of the rest) of each text; counts every string of that length."""
    all_bytes = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in all_bytes for i in range(len(b) - length + 1))
    out = []
    for b in all_bytes:
        covered = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        kept = bytes(x for x, c in zip(b, covered, strict=True) if not c)
        runs = sum(c and (not i or not covered[i - 1]) for i, c in enumerate(covered))
        out.append((len(b), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return out
