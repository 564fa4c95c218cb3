"""Words of a text as 64-bit hashes, and hashes of runs of words in linear time."""

from __future__ import annotations

import functools

import numpy as np
import xxhash

from kedai.llm.common import mix64

# Any odd multipliers do; each gives an independent family of run hashes.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MASK = (1 << 64) - 1


def split_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text as UTF-8: bytes.split() knows the same six blanks."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def lower_ascii(text: str | None) -> str:
    """The text with A-Z lower-cased and everything else as it is."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    return raw.decode("utf-8", "surrogatepass")


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


@functools.lru_cache(maxsize=8)
def _powers(base: int, size: int) -> np.ndarray:
    """base**0 .. base**(size - 1) modulo 2**64, by doubling."""
    out = np.ones(1, dtype=np.uint64)
    while len(out) < size:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out[:size]


class Runs:
    """Hashes of word runs [start, start + length) of one text, from prefix sums modulo 2**64."""

    def __init__(self, hashes: np.ndarray, multiplier: int = MULTIPLIERS[0]):
        size = max(1024, 1 << (len(hashes) + 1).bit_length())
        self._inverse = _powers(pow(multiplier, -1, 1 << 64), size)
        self._sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * _powers(multiplier, size)[: len(hashes)], out=self._sums[1:])

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        sums = self._sums[starts + length] - self._sums[starts]
        return mix64(sums * self._inverse[starts])

    def all(self, length: int) -> np.ndarray:
        return self.at(np.arange(max(0, len(self._sums) - length)), length)
