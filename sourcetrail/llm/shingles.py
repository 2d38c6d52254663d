"""Words and hashed word shingles of whole texts, on numpy arrays."""

from __future__ import annotations

import numpy as np
import xxhash

_U = np.uint64
_GOLDEN = _U(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Word -> 64-bit hash, remembered; `trim` keeps the memory bounded."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def trim(self, limit: int = 200_000) -> None:
        if len(self) > limit:
            self.clear()


def words(text: str | None) -> list[bytes]:
    """Maximal runs of [^\\x20\\x09-\\x0D] with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def hashes(tokens: list[bytes], cache: WordHashes) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, tokens), np.uint64, len(tokens))


def shingle_set(tokens: list[bytes], k: int, cache: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of k words; of the whole sequence if it is shorter; empty without words."""
    w = hashes(tokens, cache)
    if not len(w):
        return w
    size = min(k, len(w))
    n = len(w) - size + 1
    h = np.full(n, size, np.uint64)
    for i in range(size):
        h = mix(h * _GOLDEN + w[i : i + n])
    return np.unique(h)
