"""Words of a text as bytes, and 64-bit hashes of word runs as numpy arrays.

Used inside Arrow batches. Texts are never shortened: every function takes the whole text.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash

#: Bytes of a folded word: digits, a-z and everything beyond ASCII; A-Z become a-z, the rest separates.
FOLD = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SECOND = np.uint64(0xC2B2AE3D27D4EB4F)


def plain_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, unchanged. NULL has none."""
    return text.encode().split() if text else []


def folded_words(text: str | None) -> list[bytes]:
    """Lower-cased runs of digits, letters and non-ASCII characters. NULL has none."""
    return text.encode().translate(FOLD).split() if text else []


class WordCodes(dict):
    """Word to 64-bit hash; forgets everything when it has grown to ``limit`` words, so memory stays bounded."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = code = xxhash.xxh64_intdigest(word)
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def run_hashes(codes: np.ndarray, width: int, multiplier: np.uint64 = MULTIPLIER) -> np.ndarray:
    """Hash of every run of ``width`` consecutive codes; the same run has the same hash anywhere.

    A polynomial modulo 2**64 by doubling: a run of 2m is two runs of m, so a width costs its number of bits.
    """
    n = len(codes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total, have, part, size, power = None, 0, codes, 1, int(multiplier)
    rest, mask = width, (1 << 64) - 1
    while rest:
        if rest & 1:
            piece = part[have : have + n]
            total = piece.copy() if total is None else total * np.uint64(power) + piece
            have += size
        rest >>= 1
        if rest:
            part = part[:-size] * np.uint64(power) + part[size:]
            size, power = size * 2, power * power & mask
    return mix(total)


def split_ranges(lengths: Iterable[int]) -> np.ndarray:
    """Start offsets of consecutive pieces, with the end as the last entry."""
    return np.concatenate([[0], np.cumsum(np.fromiter(lengths, np.int64))])
