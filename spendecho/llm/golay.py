"""The binary Golay code of length 23: every word is within 3 bits of one codeword."""

from __future__ import annotations

from itertools import combinations

import numpy as np

LENGTH, CHECKS = 23, 11
GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def _remainders() -> np.ndarray:
    """Remainder of each single bit modulo the generator."""
    out, x = [], 1
    for _ in range(LENGTH):
        out.append(x)
        x <<= 1
        if x >> CHECKS:
            x ^= GENERATOR
    return np.array(out, dtype=np.int64)


_BITS = _remainders()


def _linear(bits: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << len(bits), dtype=np.int64)
    for i, value in enumerate(bits):
        table[1 << i : 2 << i] = table[: 1 << i] ^ value
    return table


_LOW, _HIGH = _linear(_BITS[:12]), _linear(_BITS[12:])
_ERRORS = np.zeros(1 << CHECKS, dtype=np.int64)
for _n in (1, 2, 3):
    for _at in combinations(range(LENGTH), _n):
        _ERRORS[np.bitwise_xor.reduce(_BITS[list(_at)])] = sum(1 << i for i in _at)


def decode(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the nearest codeword of each 23-bit word."""
    return (words ^ _ERRORS[_LOW[words & 0xFFF] ^ _HIGH[words >> 12]]) >> CHECKS


def nearby(words: np.ndarray, bits: int = LENGTH) -> np.ndarray:
    """Indices that each word, or the word with one of its first `bits` bits turned,
    decodes to; one row per word, repeats as -1. Words that differ in two of these
    bits or less have an index in common: that of the word between them."""
    ball = words[:, None] ^ np.concatenate([[0], 1 << np.arange(bits)])[None, :]
    found = np.sort(decode(ball), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return found
