"""Elias-Fano sequences over memory-mapped words, vectorised."""

from __future__ import annotations

import numpy as np

U = np.uint64


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Numbers of ``width`` bits each in 64-bit words."""
    n = len(values)
    words = np.zeros((n * width + 63) // 64 + 1, U)
    if width and n:
        at = np.arange(n, dtype=np.int64) * width
        word, shift = at >> 6, (at & 63).astype(U)
        v = values.astype(U)
        np.bitwise_or.at(words, word, v << shift)
        over = (shift + U(width)) > U(64)
        np.bitwise_or.at(words, word[over] + 1, v[over] >> (U(64) - shift[over]))
    return words


def read_bits(words: np.ndarray, width: int, index: np.ndarray) -> np.ndarray:
    if not width:
        return np.zeros(len(index), np.int64)
    at = index.astype(np.int64) * width
    word, shift = at >> 6, (at & 63).astype(U)
    low = words[word] >> shift
    high = np.where(shift == 0, U(0), words[word + 1] << ((U(64) - shift) & U(63)))
    return ((low | high) & U((1 << width) - 1)).astype(np.int64)


def encode(values: np.ndarray) -> np.ndarray:
    """A rising sequence of integers >= 0 as words: [n, low bits, words of low parts, samples, bits
    of high parts]. Value i has its low bits in place i and its high part as the i-th set bit, at
    position high + i; the number of set bits before every 64-bit word is kept for selection."""
    n = len(values)
    top = int(values[-1]) if n else 0
    width = max(0, int(np.floor(np.log2(top / n))) if n and top > n else 0)
    v = values.astype(np.int64)
    low = pack_bits(v & ((1 << width) - 1), width)
    place = (v >> width) + np.arange(n)
    bits = np.zeros(((int(place[-1]) if n else 0) >> 6) + 1, U)
    np.bitwise_or.at(bits, place >> 6, U(1) << (place & 63).astype(U))
    before = np.zeros(len(bits), np.int64)
    np.cumsum(np.bitwise_count(bits)[:-1], out=before[1:])
    head = np.array([n, width, len(low), len(bits)], U)
    return np.concatenate([head, low, before.astype(U), bits])


class EliasFano:
    """Access by index to an encoded sequence; ``words`` may be a memory map."""

    def __init__(self, words: np.ndarray):
        self.n, self.width, nl, nb = (int(x) for x in words[:4])
        self.low = words[4:4 + nl]
        self.before = words[4 + nl:4 + nl + nb].view(np.int64)
        self.bits = words[4 + nl + nb:4 + nl + 2 * nb]

    def __getitem__(self, index: np.ndarray) -> np.ndarray:
        index = np.asarray(index, np.int64)
        word = np.searchsorted(self.before, index, "right") - 1
        left = (index - self.before[word]).astype(np.int64)  # set bits to skip inside the word
        w = self.bits[word].copy()
        pos = np.zeros(len(index), np.int64)
        for half in (32, 16, 8, 4, 2, 1):  # halve the word towards the wanted bit
            part = w & U((1 << half) - 1)
            count = np.bitwise_count(part).astype(np.int64)
            up = left >= count
            left = np.where(up, left - count, left)
            w = np.where(up, w >> U(half), part)
            pos += np.where(up, half, 0)
        high = (word << 6) + pos - index
        return (high << self.width) | read_bits(self.low, self.width, index)

    def decode(self, first: int, last: int) -> np.ndarray:
        """Values first .. last - 1 in one pass."""
        if last <= first:
            return np.zeros(0, np.int64)
        a = int(np.searchsorted(self.before, first, "right")) - 1
        b = int(np.searchsorted(self.before, last - 1, "right"))
        bits = np.unpackbits(np.ascontiguousarray(self.bits[a:b]).view(np.uint8), bitorder="little")
        at = np.flatnonzero(bits) + (a << 6)
        index = np.arange(first, last)
        high = at[first - int(self.before[a]):last - int(self.before[a])] - index
        return (high << self.width) | read_bits(self.low, self.width, index)
