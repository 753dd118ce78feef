"""Word shingles as 64-bit hashes, computed with numpy on whole texts.

Words are maximal runs of bytes other than ASCII white space (0x20, 0x09-0x0D)
after lower-casing A-Z, the same as ``bytes.lower().split()``. A shingle of
``width`` words is a multilinear hash of the words' 64-bit hashes with fixed
odd multipliers, finished by a mixing step. A text with fewer words than
``width`` has its whole word sequence as the one shingle; a text without words
has none. Two different shingles collide with probability of about 2**-64.
"""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5

_GOLDEN = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _odd(k: int) -> int:
    """k-th odd multiplier of the multilinear hash, made by one splitmix step."""
    z = ((k + 1) * _GOLDEN) & _MASK
    z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
    z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & _MASK
    return (z ^ (z >> 31)) | 1


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    h = h.copy()
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(_GOLDEN)
    h ^= h >> np.uint64(32)
    return h


class WordHashes(dict):
    """Word -> 64-bit hash, remembered up to a bound and then forgotten."""

    def __init__(self, bound: int = 400_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: str | None) -> list:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each window of ``width`` consecutive word hashes."""
    n = len(hashes) - width + 1
    out = np.full(n, np.uint64(width), np.uint64)
    for k in range(width):
        out += hashes[k : k + n] * np.uint64(_odd(k))
    return mix(out)


def shingle_set(text: str | None, memo: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes of a text (empty for no words)."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(windows(memo.of(words), min(width, len(words))))
