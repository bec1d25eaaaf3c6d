"""The perfect binary Golay code (23, 12): words to codeword indices.

Every 23-bit word lies within three bits of exactly one codeword. All tables
follow from the generator polynomial.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

BITS = 23
CHECKS = 11

#: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 (fixed value: the code's generator).
GENERATOR = 0b101011100011


@cache
def _remainders() -> tuple[np.ndarray, np.ndarray]:
    """Remainder of each possible high part (12 bits), and the error of up to
    three bits that belongs to each remainder."""
    high = np.arange(1 << (BITS - CHECKS), dtype=np.int64) << CHECKS
    rest = high.copy()
    for bit in range(BITS - 1, CHECKS - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - CHECKS)), rest)
    errors = np.zeros(1 << CHECKS, np.int64)
    for weight in range(4):
        for bits in combinations(range(BITS), weight):
            error = sum(1 << bit for bit in bits)
            errors[rest[error >> CHECKS] ^ (error & ((1 << CHECKS) - 1))] = error
    return rest, errors


def nearest(words: np.ndarray) -> np.ndarray:
    """The index (its high 12 bits) of the codeword nearest to each word."""
    rest, errors = _remainders()
    syndrome = rest[words >> CHECKS] ^ (words & ((1 << CHECKS) - 1))
    return (words ^ errors[syndrome]) >> CHECKS


def around(words: np.ndarray) -> np.ndarray:
    """A row for each word: the indices nearest to it and to its 23 neighbours.

    They are one index or six, with repeats. Two words that differ in one bit:
    the nearest index of either is in the row of the other.
    """
    flips = np.array([0, *(1 << bit for bit in range(BITS))], np.int64)
    return nearest(words[:, None] ^ flips)
