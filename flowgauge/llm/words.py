"""Hashes of words and of word sequences, in whole arrays."""

from __future__ import annotations

import numpy as np
import xxhash

#: A task forgets the words it has hashed beyond this many bytes of them.
REMEMBERED_BYTES = 16 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x`` (uint64); different numbers stay different."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def followed_by(head: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of sequences ``head`` with one more word."""
    return mix(head * _ODD + word)


def _inverse(odd: int) -> np.uint64:
    return np.uint64(pow(odd, -1, 1 << 64))


def _unshifted(x: np.ndarray, shift: int) -> np.ndarray:
    """The numbers of which ``y ^ (y >> shift)`` made ``x``, for shifts above 21."""
    return x ^ (x >> np.uint64(shift)) ^ (x >> np.uint64(2 * shift))


def unmix(x: np.ndarray) -> np.ndarray:
    """The number that ``mix`` made ``x`` of."""
    x = _unshifted(x, 31) * _inverse(0x94D049BB133111EB)
    x = _unshifted(x, 27) * _inverse(0xBF58476D1CE4E5B9)
    return _unshifted(x, 30)


def head_of(sequence: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hashes ``head`` with ``followed_by(head, word) == sequence``."""
    return (unmix(sequence) - word) * _inverse(int(_ODD))


class WordHashes(dict):
    """word (bytes) -> XXH64, each computed once while it is remembered."""

    def __init__(self):
        self.room = REMEMBERED_BYTES

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        self.room -= len(word) + 128
        if self.room < 0:
            self.clear()
            self.room = REMEMBERED_BYTES
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))
