"""64-bit hashes of words and n-grams in numpy."""

from __future__ import annotations

import sys

import numpy as np
import xxhash
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

C1, C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class WordHashes(dict):
    """XXH64 of words, remembered for at most ``limit`` of them."""

    limit = 200_000

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, 42)
        if len(self) >= self.limit:
            self.clear()
        self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * C2
    h = (h ^ (h >> np.uint64(32))) * C2
    return h ^ (h >> np.uint64(32))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two hashes in order."""
    return mix(a * C1 + b)
