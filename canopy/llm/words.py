"""Word and shingle hashes of raw texts, for tasks."""

from __future__ import annotations

import numpy as np
import xxhash

#: Entries of a worker's word-hash cache; beyond, it starts anew. It only saves time.
CACHE_WORDS = 200_000
_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), 0x9E3779B97F4A7C15
_ROLL = [np.uint64((_GOLD * (2 * i + 1)) % 2**64 | 1) for i in range(1, 9)]


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = WordHashes()


def drop_caches() -> None:
    _HASHES.clear()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    return x ^ (x >> np.uint64(31))


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of every window of n word hashes."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    acc = h[:len(h) - n + 1] * _ROLL[0]
    for i in range(1, n):
        acc += h[i:len(h) - n + 1 + i] * _ROLL[i]
    return mix(acc)


def shingles(text: bytes | None, n: int = 5) -> np.ndarray:
    """The sorted set of n-word shingles: words of the text with A-Z lower-cased. A shorter text is
    one shingle, a text without words none."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = word_hashes(words)
    return np.unique(ngram_hashes(h, min(n, len(h))) + np.uint64(max(0, n - len(h))))
