"""Byte-level BPE ids of whole texts through a per-task dictionary of distinct pre-tokens."""

from __future__ import annotations

import numpy as np

from fipsight.llm.text import gather_spans, pretoken_starts, span_hashes, worker_cache

U = np.uint64


def byte_letters() -> str:
    """The printable letter that the vocabulary file writes for each byte value."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [], 256
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return "".join(out)


def load_tokenizer(path: str):
    """(tokenizer, its model, the contents of its added tokens), once per worker."""
    def build():
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers
        t = tokenizers.Tokenizer.from_file(path)
        return t, t.model, [a.content for a in t.get_added_tokens_decoder().values()]
    return worker_cache("tokenizer:" + path, build)


class WordTable:
    """Maps 64-bit word hashes to slots 0, 1, ... in order of first meeting.

    Sorted keys with a sorted overflow that is merged when it has grown, so a look-up is two
    binary searches over a whole chunk of words.
    """

    def __init__(self):
        self.keys = np.zeros(0, U)
        self.slots = np.zeros(0, np.int64)
        self.size = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slots of distinct keys, -1 where absent."""
        if not self.size:
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), self.size - 1)
        return np.where(self.keys[at] == keys, self.slots[at], -1)

    def add(self, keys: np.ndarray) -> np.ndarray:
        """Give new slots to absent, sorted, distinct keys."""
        slots = self.size + np.arange(len(keys))
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.slots = np.insert(self.slots, at, slots)
        self.size += len(keys)
        return slots

    def rename(self, keys: np.ndarray, slots: np.ndarray) -> None:
        """Give known keys other slots."""
        self.slots[np.searchsorted(self.keys, keys)] = slots


def split_words(data: np.ndarray, off: np.ndarray):
    """(starts, ends, first occurrence of each distinct word, sorted distinct hashes, inverse)."""
    st = pretoken_starts(data, off)
    en = np.append(st[1:], len(data))
    keys, first, inverse = np.unique(span_hashes(data, st, en), return_index=True, return_inverse=True)
    return st, en, first, keys, inverse


class TextEncoder:
    """Ids of whole texts; each distinct pre-token of the task goes to the library's BPE model once.

    ``limit`` only bounds the memory of the dictionary: when more words are known it starts anew.
    """

    def __init__(self, path: str, limit: int = 1_000_000):
        self.path, self.limit = path, limit
        self.letters = {i: c for i, c in enumerate(byte_letters())}
        self.reset()

    def reset(self) -> None:
        self.table = WordTable()
        self.ids = np.zeros(0, np.int32)
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets by text) of the texts in one chunk."""
        _, model, _ = load_tokenizer(self.path)
        if self.table.size > self.limit:
            self.reset()
        st, en, first, keys, inverse = split_words(data, off)
        slot = self.table.find(keys)
        new = np.flatnonzero(slot < 0)
        if len(new):
            text = data.tobytes().decode("latin-1").translate(self.letters)
            ids, count = [], []
            for a, b in zip(st[first[new]].tolist(), en[first[new]].tolist()):
                got = model.tokenize(text[a:b])
                ids.extend([t.id for t in got])
                count.append(len(got))
            slot[new] = self.table.add(keys[new])
            count = np.array(count, np.int64)
            self.start = np.append(self.start, len(self.ids) + np.cumsum(count) - count)
            self.count = np.append(self.count, count)
            self.ids = np.append(self.ids, np.array(ids, np.int32))
        token = slot[inverse]
        ids, edge = gather_spans(self.ids, self.start[token], self.count[token])
        return ids, edge[np.searchsorted(st, off)]

    def encode_rows(self, data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
        """Ids of each text; texts that hold the string of an added token go through the whole
        library, which gives that string its own id."""
        tok, _, added = load_tokenizer(self.path)
        ids, edge = self.encode(data, off)
        out = [ids[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
        raw = data.tobytes()
        for word in added:
            w = word.encode()
            if w in raw:
                for i in range(len(out)):
                    t = raw[off[i]:off[i + 1]]
                    if w in t:
                        out[i] = np.array(tok.encode(t.decode("utf-8"), add_special_tokens=False).ids, np.int32)
        return out
