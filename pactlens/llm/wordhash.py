"""Words as 64-bit hashes, remembered for a task's lifetime within a bound."""

from __future__ import annotations

import numpy as np
import xxhash

MOST_WORDS = 500_000


class WordHashes(dict):
    """Hash of a word by look-up; forgets everything when ``MOST_WORDS`` are known, which costs time only."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of a 64-bit number over all of them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
