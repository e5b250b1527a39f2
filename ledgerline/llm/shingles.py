"""Word shingles as 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

import numpy as np
import xxhash

#: Distinct words whose hashes a task keeps at a time.
KEPT_WORDS = 200_000


class WordHashes(dict):
    """64-bit hash of a word; forgets all words when it holds too many, which changes no value."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of all ``k``-word shingles; fewer words are one shingle, none is an empty set."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(k, n)
    total = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + hashes[j : n - width + 1 + j])
    total.sort()
    return total[np.concatenate(([True], total[1:] != total[:-1]))]
