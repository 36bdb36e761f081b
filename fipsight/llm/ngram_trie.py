"""N-gram trie in Elias-Fano levels on a memory-mapped file."""

from __future__ import annotations

import tempfile

import numpy as np

from fipsight.llm.eliasfano import EliasFano, encode

U = np.uint64
EXACT = 1 << 15  # counts below are kept exactly, larger ones in steps of 0.1 %


def quantise(count: np.ndarray) -> np.ndarray:
    """16-bit codes of counts; a code never stands for more than the count."""
    c = np.maximum(count.astype(np.float64), 1.0)
    step = EXACT + np.floor(np.log(c / EXACT) / np.log(1.001) + 1e-9)
    return np.where(count < EXACT, count, np.minimum(step, (1 << 16) - 1)).astype(np.uint16)


def restore(code: np.ndarray) -> np.ndarray:
    code = code.astype(np.float64)
    return np.where(code < EXACT, code, np.floor(EXACT * 1.001 ** (code - EXACT)))


class NgramTrie:
    """Levels 1 .. order of a set of n-grams over 64-bit word hashes, with a code for each full n-gram.

    Words get dense numbers by the sorted dictionary of the trie, unless the grams are of numbers below
    ``numbers`` already. A level holds, for every node in
    order, its word number plus the last value before its parent's range, which makes the level one
    rising sequence, and the level below's range starts as another one. A look-up goes down from the
    range of the context: the successor of (value before the range + word number) is the wanted node
    or shows that it is absent.
    """

    def __init__(self, grams: list[np.ndarray], code: np.ndarray, numbers: int | None = None):
        """``grams``: one array of word hashes (or numbers) per position; rows distinct and sorted."""
        n = len(code)
        self.words = np.unique(np.concatenate([np.zeros(0, U), *grams])) if numbers is None else None
        ids = [self._number(g)[0] for g in grams]
        new = np.zeros(n, bool)
        new[:1] = True
        parts, self.place = [], []
        parent_start = np.zeros(1, np.int64)  # rows at which the parents of this level start
        for w in ids:
            new = new.copy()
            new[1:] |= w[1:] != w[:-1]
            node = np.flatnonzero(new)
            value = w[node]
            start = np.searchsorted(node, parent_start)  # first node of every parent
            size = np.diff(np.append(start, len(node)))
            last = np.append(0, np.cumsum(value[start + size - 1]))[:-1] if len(node) else np.zeros(0, np.int64)
            parts += [encode(np.append(start, len(node))), encode(value + np.repeat(last, size) if len(node) else value)]
            parent_start = node
        self.file = tempfile.TemporaryFile()  # gone with this object
        at = 0
        for p in parts:
            self.file.write(p.tobytes())
            self.place.append((at, len(p)))
            at += len(p)
        self.file.write(code.astype(np.uint16).tobytes())
        self.file.flush()
        whole = np.memmap(self.file, U, "r", 0, (at,)) if at else np.zeros(0, U)
        level = [EliasFano(whole[a:a + k]) for a, k in self.place]
        self.pointers, self.levels = level[0::2], level[1::2]
        self.codes = np.memmap(self.file, np.uint16, "r", at * 8, (n,)) if n else np.zeros(0, np.uint16)

    def _number(self, g: np.ndarray):
        """Numbers of words, and which of them the dictionary has."""
        if self.words is None:
            return g.astype(np.int64), np.ones(len(g), bool)
        at = np.minimum(np.searchsorted(self.words, g), max(len(self.words) - 1, 0))
        return at.astype(np.int64), self.words[at] == g if len(self.words) else np.zeros(len(g), bool)

    def find(self, grams: list[np.ndarray], batch: int = 1 << 17) -> np.ndarray:
        """Codes of n-grams (0 if absent); fastest when sorted."""
        out = np.zeros(len(grams[0]), np.uint16)
        if not len(self.codes):
            return out
        for a in range(0, len(out), batch):
            node = np.zeros(min(batch, len(out) - a), np.int64)
            alive = np.ones(len(node), bool)
            for pointers, level, g in zip(self.pointers, self.levels, grams):
                number, has = self._number(g[a:a + batch])
                alive &= has
                low, high = self._range(pointers, node, alive)
                node, found = self._successor(level, low, high, number, alive)
                alive &= found
            out[a:a + batch][alive] = self.codes[node[alive]]
        return out

    @staticmethod
    def _range(pointers: EliasFano, node: np.ndarray, alive: np.ndarray):
        node = np.where(alive, node, 0)
        first, last = int(node.min()), int(node.max())
        near = pointers.decode(first, last + 2)
        return near[node - first], near[node - first + 1]

    @staticmethod
    def _successor(level: EliasFano, low: np.ndarray, high: np.ndarray, number: np.ndarray, alive: np.ndarray):
        if not alive.any():
            return np.zeros(len(low), np.int64), alive
        first, last = max(0, int(low[alive].min()) - 1), int(high[alive].max())
        value = level.decode(first, last)
        low, high = np.where(alive, low, first), np.where(alive, high, first)
        base = np.where(low > 0, value[np.maximum(low - 1 - first, 0)], 0)
        at = np.maximum(np.searchsorted(value, base + number) + first, low)
        inside = np.minimum(at - first, len(value) - 1)
        return np.where(at < high, at, 0), (at < high) & (value[inside] == base + number)
