"""Word shingles as 64-bit hashes, by numpy, for the operators that compare
word sequences."""

from __future__ import annotations

import numpy as np
import xxhash

REMEMBERED = 200_000  # word hashes that a task remembers; memory only

_MASK = (1 << 64) - 1


class WordHashes(dict):
    """Word (bytes) to its 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values without visible structure (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_array(text: str | None, hashes: WordHashes, lower: bool = True) -> np.ndarray:
    """Hashes of the words (maximal runs without space or \\t..\\r) in order;
    A-Z are lower-cased, no other letters."""
    data = (text or "").encode()
    found = (data.lower() if lower else data).split()  # both exactly on the ASCII rules
    return np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of k words, in order; with fewer words none."""
    n = len(words) - k + 1
    if n <= 0:
        return words[:0]
    out = mixed(words[:n])
    for i in range(1, k):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n])
    return out


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct k-word shingles; a shorter sequence is one shingle as
    a whole, no words give the empty set."""
    if 0 < len(words) < k:
        return window_hashes(words, len(words))
    return np.unique(window_hashes(words, k))
