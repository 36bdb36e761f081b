"""Vectorised text helpers for Arrow batches inside Spark tasks.

Everything works on the UTF-8 bytes of an Arrow string column in chunks of about ``chunk`` bytes
(a longer text is a chunk of its own), so the memory of a task follows the chunk and the longest
text, not the batch. A null text is an empty text.

Word hashes are 64-bit polynomial hashes of the word's bytes, finished by a mixing step; n-gram
hashes combine the word hashes in order. They stand for the words: two different words of a
corpus with V distinct words meet with probability about V^2 / 2^65.
"""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa

U = np.uint64


def worker_cache(key: str, build):
    """Keep ``build()`` for the life of the Python worker (functions travel by value, so their
    module globals do not outlive a task)."""
    m = sys.modules.setdefault("_fipsight_worker_cache", types.ModuleType("_fipsight_worker_cache"))
    if not hasattr(m, key):
        setattr(m, key, build())
    return getattr(m, key)


def put_cache(key: str, value) -> None:
    m = sys.modules.setdefault("_fipsight_worker_cache", types.ModuleType("_fipsight_worker_cache"))
    setattr(m, key, value)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (wrapping arithmetic)."""
    h = np.asarray(h, dtype=U)
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64, at least n of them."""
    have = worker_cache("powers", lambda: (np.ones(1, U), np.ones(1, U)))
    if len(have[0]) < n:
        size = max(n, 1 << 20)
        base = 0x9E3779B97F4A7C15
        inv = pow(base, -1, 1 << 64)

        def run(x):
            a = np.full(size, x, U)
            a[0] = 1
            return np.cumprod(a, dtype=U)

        have = (run(base), run(inv))
        if size <= 1 << 23:
            put_cache("powers", have)
    return have


def byte_column(arr) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary array; nulls are empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("" if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else b"")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    off = np.frombuffer(arr.buffers()[1], np.int64 if wide else np.int32) if len(arr) else np.zeros(1, np.int64)
    off = off[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = arr.buffers()[2] if len(arr) else None
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def chunks(arr, chunk: int = 1 << 20):
    """Yield (first row, next row, bytes, offsets) over runs of rows of about ``chunk`` bytes."""
    data, off = byte_column(arr)
    n, i = len(off) - 1, 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + chunk, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def _edges(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True that do not cross a text border."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    border = np.zeros(n + 1, bool)
    border[off] = True
    st = inside.copy()
    st[1:] &= ~inside[:-1] | border[1:n]
    en = inside.copy()
    en[:-1] &= ~inside[1:] | border[1:n]
    return np.flatnonzero(st), np.flatnonzero(en) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span."""
    n = len(data)
    power, inverse = _powers(n + 1)
    prefix = np.empty(n + 1, U)
    prefix[0] = 0
    np.cumsum((data.astype(U) + U(1)) * power[:n], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


SEPARATORS = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]


def word_spans(data: np.ndarray, off: np.ndarray):
    """Words ``[^\\x20\\x09-\\x0D]+`` as (starts, ends, text index)."""
    ok = np.ones(256, bool)
    ok[SEPARATORS] = False
    st, en = _edges(ok[data], off)
    return st, en, np.searchsorted(off, st, "right") - 1


def word_hashes(data: np.ndarray, off: np.ndarray):
    """(hash, text index) of the words with A-Z lower-cased, in order."""
    data = lower_table()[data]
    st, en, doc = word_spans(data, off)
    return span_hashes(data, st, en), doc


def ngram_hashes(words: np.ndarray, doc: np.ndarray, n: int):
    """(hash, text index) of the n-word runs that stay inside one text."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    h = words[:m].copy()
    for k in range(1, n):
        h = mix(h * U(0x9E3779B97F4A7C15) + words[k:k + m])
    keep = doc[:m] == doc[n - 1:]
    return h[keep], doc[:m][keep]


def run_lengths(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal key tuples in sorted arrays."""
    n = len(keys[0])
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    st = np.flatnonzero(new)
    return st, np.diff(np.append(st, n))


def gather_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate data[starts[i]:starts[i]+lengths[i]]; returns (values, offsets)."""
    off = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=off[1:])
    at = np.arange(off[-1]) + np.repeat(starts - off[:-1], lengths)
    return data[at], off


# --- pre-tokens -------------------------------------------------------------------------------

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: The code points with the Unicode property White_Space.
WHITE_SPACE = [0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
               0x205F, 0x3000]


def _class_table() -> np.ndarray:
    """Class of every code point for the splitting pattern."""
    import unicodedata
    t = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        k = unicodedata.category(chr(c))[0]
        if k == "L":
            t[c] = LETTER
        elif k == "N":
            t[c] = NUMBER
    t[WHITE_SPACE] = SPACE
    return t


def pretoken_starts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Byte positions at which the matches of the byte-level BPE splitting pattern start.

    The pattern (contractions, optional blank + letters / numbers / other signs, white space that
    leaves its last character to the next match) covers every character, so a match ends where the
    next one or the text's end lies.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    table = worker_cache("classes", _class_table)
    code = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    n = len(code)
    cls = table[code]
    first = np.zeros(n + 1, bool)  # a text starts here
    place = np.searchsorted(at, off)
    first[place] = True
    first[n] = True
    change = np.ones(n, bool)
    change[1:] = (cls[1:] != cls[:-1]) | first[1:n]
    white = cls == SPACE
    blank = code == 0x20
    last_white = white & np.append(change[1:], True) & ~first[1:]  # ends a run that a non-blank follows
    start = change.copy()
    start |= last_white
    # a blank right before joins the run that starts here
    start[1:] &= ~(change[1:] & ~white[1:] & blank[:-1] & ~first[1:n])
    # contractions: an apostrophe that starts a match
    for i in np.flatnonzero((code == 0x27) & start).tolist():
        if i + 1 < n and not first[i + 1]:
            c = code[i + 1]
            if c in (115, 116, 109, 100):
                k = 2
            elif i + 2 < n and not first[i + 2] and (int(c), int(code[i + 2])) in ((114, 101), (118, 101), (108, 108)):
                k = 3
            else:
                continue
            start[i + 1] = False
            if i + k < n and not first[i + k] and cls[i + k] == LETTER:
                start[i + k] = True
    return at[start]
