"""Fuzzy keys of binary words by the perfect (23, 12) Golay code.

Every word of 23 bits is within three bits of exactly one codeword. The keys of
a word are the codewords that the word itself and its one-bit changes decode
to: six at most. Two words that differ in two bits have a word between them that
is one change from either, so they share a key.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

BITS = 23
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1


@cache
def codewords() -> np.ndarray:
    """The 4096 codewords: 12 bits of data, then 11 of remainder."""
    words = []
    for data in range(4096):
        rest = data << 11
        for bit in range(BITS - 1, 10, -1):
            if rest >> bit & 1:
                rest ^= GENERATOR << (bit - 11)
        words.append(data << 11 | rest)
    return np.array(words, dtype=np.int64)


@cache
def decoder() -> np.ndarray:
    """For each word of 23 bits the number of its codeword (16 MB)."""
    table = np.zeros(1 << BITS, dtype=np.uint16)
    code = codewords()
    numbers = np.arange(4096, dtype=np.uint16)
    for weight in range(4):
        for bits in combinations(range(BITS), weight):
            table[code ^ sum(1 << b for b in bits)] = numbers
    return table


def keys(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of words of ``bits`` bits, six columns, and which of them count."""
    table = decoder()
    words = words.astype(np.int64)
    flips = np.array([0] + [1 << b for b in range(bits)], dtype=np.int64)
    found = np.sort(table[words[:, None] ^ flips[None, :]], axis=1).astype(np.int64)
    new = np.ones(found.shape, bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    # New ones to the front, in order; a word has six different ones at most.
    order = np.argsort(~new, axis=1, kind="stable")[:, :6]
    return np.take_along_axis(found, order, axis=1), np.take_along_axis(new, order, axis=1)
