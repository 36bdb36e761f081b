"""Language-model scoring with sharded Elias-Fano n-gram tries.

Tokens are words (runs without white space, A-Z lower-cased) and one end per text; the context of
the first token is a begin mark. The model is of order 2 or 3, with Dirichlet smoothing::

    p(w)       = (count(w) + 1) / (tokens + distinct + 1)
    p(w | u)   = (count(u w) + MU p(w)) / (count(u) + MU)
    p(w | u v) = (count(u v w) + MU p(w | v)) / (count(u v) + MU)

with counts over all learning texts; the first token of a text has no context beyond the begin mark,
so it takes p(w | u) in both orders. A block (a run of a task's texts) first counts its words and sends
each shard of words one row; the shards add up exact counts and name the most frequent words, at most
``FREQUENT`` in all, which from then on travel as small numbers. Then the block sends its pairs and
triples, one row for each shard, with a dictionary of the row's rarer words; a shard builds an
``NgramTrie`` of all blocks' grams with quantised counts and answers those of every block from it.
The answers go back to the blocks, which score their texts. Pairs and triples are
dealt by their context and a part (one of ``SALT``) of their last word, so that a word that a third of
all tokens follow is spread, and a block names each once. No task holds the model: the number of shards
follows the bytes of all texts (one for each ``SHARD_BYTES``, at least the session's shuffle partitions).

All branches read the same rows, so ``docs`` must be deterministic (a table scan).

Cases: null text = empty text (one end token); an id with remainder 2 or a null id is not learned
from; no learning text gives probability 1 to the only possible outcome; empty table = no rows;
repeated rows are counted and scored each; clashing extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fipsight.llm.ngram_trie import NgramTrie, quantise, restore
from fipsight.llm.numbers import pack_numbers, unpack_numbers
from fipsight.llm.samples import id_remainder
from fipsight.llm.store import Folder
from fipsight.llm.text import chunks, mix, run_lengths, word_hashes

U = np.uint64
BEGIN, END = 1, 2  # stand-ins for hashes
MU = 4.0
SALT = 8
FREQUENT = 1 << 16  # words with a number of their own
SHARD_BYTES = 16 << 20
WORDS, PAIRS, TOTALS, TRIPLES = 0, 1, 2, 3  # kinds of rows
SHARD = "shard long, block long, kind int, keys binary, places binary, counts binary"
ANSWER = "block long, shard long, kind int, counts binary, words binary"


class Frequent:
    """The most frequent words (sorted) and their numbers by falling count."""

    def __init__(self, words: np.ndarray, number: np.ndarray):
        self.words, self.number = words, number

    def __len__(self) -> int:
        return len(self.words)

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """The number of each word, or the number of frequent words for any other."""
        out = np.full(len(words), len(self.words))
        at = np.searchsorted(self.words, words)
        known = at < len(self.words)
        known[known] = self.words[at[known]] == words[known]
        out[known] = self.number[at[known]]
        return out


def pack_grams(grams: list[np.ndarray]) -> bytes:
    """Sorted distinct rows of numbers: each column as steps within the run of equal columns before it."""
    steps, new = [], np.zeros(len(grams[0]), bool)
    new[:1] = True
    for g in grams:
        step = g.astype(np.int64)
        step[1:] -= np.where(new[1:], 0, g[:-1])
        steps.append(step)
        new[1:] |= g[1:] != g[:-1]
    return pack_numbers(np.concatenate(steps))


def unpack_grams(raw: bytes, order: int) -> list[np.ndarray]:
    steps = unpack_numbers(raw).astype(np.int64).reshape(order, -1)
    grams, new = [], np.zeros(steps.shape[1], bool)
    new[:1] = True
    for step in steps:
        sums, start = np.cumsum(step), np.flatnonzero(new)
        g = sums - np.repeat(sums[start] - step[start], np.diff(np.append(start, len(step))))
        grams.append(g)
        new[1:] |= g[1:] != g[:-1]
    return grams


class Block:
    """Distinct words and pairs of a run of texts, given the hashes of their tokens. Words that
    ``frequent`` numbers come first, by that number, then the others, by falling count."""

    def __init__(self, tokens: np.ndarray, sizes: np.ndarray, learn: np.ndarray, frequent: Frequent | None):
        self.sizes = sizes  # tokens of each text, its end included
        slots, words = pd.factorize(np.append(tokens, np.array([BEGIN], U)))
        place = -np.bincount(slots)
        if frequent is not None:
            number = frequent.numbers(words)
            place = np.where(number < len(frequent), number, place + len(frequent) + len(slots))
        order = np.argsort(place, kind="stable")
        if frequent is not None:
            self.numbers = number[order][:int((number < len(frequent)).sum())]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.words, slots = words[order], rank[slots]
        self.begin, self.slots = int(slots[-1]), slots[:-1]
        self.learned = np.repeat(learn, sizes)

    @classmethod
    def of_slots(cls, words: np.ndarray, slots: np.ndarray, sizes: np.ndarray) -> Block:
        """The same block from its stored parts."""
        self = cls.__new__(cls)
        self.words, self.slots, self.sizes = words, slots, sizes
        self.begin = self.slot(BEGIN)
        self.learned = np.zeros(len(slots), bool)
        return self

    def slot(self, word: int) -> int:
        return int(np.flatnonzero(self.words == U(word))[0])

    def pairs(self):
        """(slot of u, slot of w, learned count) of distinct pairs in order, and each token's pair."""
        before = np.empty(len(self.slots), np.int64)
        before[1:] = self.slots[:-1]
        before[np.cumsum(self.sizes) - self.sizes] = self.begin
        key, pair = np.unique(before * len(self.words) + self.slots, return_inverse=True)
        count = np.bincount(pair[self.learned], minlength=len(key))
        return key // len(self.words), key % len(self.words), count, pair

    def triples(self, first: np.ndarray, second: np.ndarray, pair: np.ndarray):
        """(slots of u, v, w, learned count) of distinct triples in order, given ``pairs()``; each
        token's triple but those of the first tokens of texts, and the places of these tokens."""
        inner = np.ones(len(self.slots), bool)
        inner[np.cumsum(self.sizes) - self.sizes] = False
        at = np.flatnonzero(inner)
        key, triple = np.unique(pair[at - 1] * len(self.words) + self.slots[at], return_inverse=True)
        count = np.bincount(triple[self.learned[at]], minlength=len(key))
        before = key // len(self.words)
        return first[before], second[before], key % len(self.words), count, triple, at

    def triple_shards(self, u: np.ndarray, v: np.ndarray, w: np.ndarray, shards: int) -> np.ndarray:
        part = mix(mix(self.words) % U(SALT) + U(9))
        return mix(mix(mix(self.words + U(3))[u] + self.words[v]) + part[w]) % U(shards)

    def word_runs(self, shards: int):
        """(shard, slots of its words by hash): the same with and without frequent words."""
        by_hash = np.argsort(self.words)
        return [(s, by_hash[at]) for s, at in _runs(mix(self.words[by_hash]) % U(shards))]

    def pair_shards(self, u: np.ndarray, w: np.ndarray, shards: int) -> np.ndarray:
        part = mix(self.words % U(SALT) + U(9))
        return mix(self.words[u] + part[w]) % U(shards)


def _runs(shard: np.ndarray):
    """(shard, places in the block's order) of every shard that has any."""
    order = np.argsort(shard.astype(np.uint16) if not len(shard) or int(shard.max()) < 1 << 16 else shard, kind="stable")
    start, size = run_lengths(shard[order])
    return [(int(shard[order[a]]), order[a:a + n]) for a, n in zip(start.tolist(), size.tolist())]


def _blocks(batches, block_bytes: int, frequent: Frequent | None = None):
    """Yield (block id, ids, learn flags, Block) of runs of texts of about ``block_bytes``."""
    base, k = TaskContext.get().partitionId() << 31, 0
    ids, learn, tokens, sizes, held = [], [], [], [], 0
    end = np.array([END], U)

    def give():
        return base + k, ids, np.array(learn, bool), Block(np.concatenate(tokens), np.concatenate(sizes),
                                                           np.array(learn, bool), frequent)
    for batch in batches:
        names, flags = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for i, j, data, off in chunks(batch.column(1), 1 << 19):
            words, doc = word_hashes(data, off)
            count = np.bincount(doc, minlength=j - i)
            tokens.append(np.insert(words, np.cumsum(count), end[0]))
            sizes.append(count + 1)
            ids += names[i:j]
            learn += flags[i:j]
            held += len(data) + 8 * (j - i)
            if held >= block_bytes:
                yield give()
                ids, learn, tokens, sizes, held, k = [], [], [], [], 0, k + 1
    if ids:
        yield give()


def _shard_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      ["shard", "block", "kind", "keys", "places", "counts"])


def word_rows(docs: DataFrame, block_bytes: int, shards: int) -> DataFrame:
    """The distinct words of every block with their learned counts, a row for each shard."""
    def run(batches):
        for block, _, _, b in _blocks(batches, block_bytes):
            count = np.bincount(b.slots[b.learned], minlength=len(b.words))
            yield _shard_batch([(s, block, WORDS, b.words[at].tobytes(), None, pack_numbers(count[at]))
                                for s, at in b.word_runs(shards)])
    return docs.mapInArrow(run, SHARD)


def word_answers(rows: DataFrame, shards: int) -> DataFrame:
    """Exact counts of every block's words, in its order; a row of totals (tokens, distinct words) of
    each shard, with its share of the frequent words."""
    most = FREQUENT // shards

    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard, counts = key[0].as_py(), [unpack_numbers(x.as_py()) for x in table.column("counts")]
        edge = np.append(0, np.cumsum([len(c) for c in counts]))
        words = np.concatenate([np.zeros(0, U), *[np.frombuffer(x.as_py(), U) for x in table.column("keys")]])
        at, word = pd.factorize(words)
        total = np.bincount(at, np.concatenate([np.zeros(0), *counts]), minlength=len(word)).astype(np.int64)
        top = np.argsort(-total, kind="stable")[:most]
        top = top[total[top] > 1]
        out = [(b, shard, WORDS, pack_numbers(total[at[x:y]]), None)
               for b, x, y in zip(table.column("block").to_pylist(), edge[:-1], edge[1:])]
        sums = np.concatenate([[total.sum(), (total > 0).sum()], total[top]]).astype(np.int64)
        out.append((None, shard, TOTALS, sums.tobytes(), word[top].tobytes()))
        return _answer_table(out)
    return rows.groupBy("shard").applyInArrow(run, ANSWER)


def _answer_table(rows: list[tuple]) -> pa.Table:
    types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    return pa.table({n: pa.array([r[k] for r in rows], t)
                     for k, (n, t) in enumerate(zip(["block", "shard", "kind", "counts", "words"], types))})


def gram_rows(docs: DataFrame, block_bytes: int, shards: int, order: int, sent) -> DataFrame:
    """The distinct pairs and triples of every block with their learned counts, a row for each shard.
    A frequent word is its number, any other the place in the row's own dictionary (``keys``) after
    these; the grams are sorted by them."""
    def run(batches):
        for block, _, _, b in _blocks(batches, block_bytes, Frequent(*sent.value)):
            known, base = len(b.numbers), len(sent.value[0])

            def row(shard, kind, grams, count):
                own = np.unique(np.concatenate([g[g >= known] for g in grams]))
                places = []
                for g in grams:
                    rare = g >= known
                    place = np.empty(len(g), np.int64)
                    place[~rare], place[rare] = b.numbers[g[~rare]], base + np.searchsorted(own, g[rare])
                    places.append(place)
                return shard, block, kind, b.words[own].tobytes(), pack_grams(places), pack_numbers(count)

            u, w, count, pair = b.pairs()
            yield _shard_batch([row(s, PAIRS, (u[at], w[at]), count[at])
                                for s, at in _runs(b.pair_shards(u, w, shards))])
            if order > 2:
                u, v, w, count, _, _ = b.triples(u, w, pair)
                del pair
                if len(u):
                    yield _shard_batch([row(shards + s, TRIPLES, (u[at], v[at], w[at]), count[at])
                                        for s, at in _runs(b.triple_shards(u, v, w, shards))])
    return docs.mapInArrow(run, SHARD)


def _gram_order(grams: list[np.ndarray], words: int) -> np.ndarray:
    """Sorting permutation of rows of word numbers below ``words``."""
    bits = max(1, int(words).bit_length())
    if bits * len(grams) > 62:
        return np.lexsort(grams[::-1])
    key = grams[0].astype(np.int64)
    for g in grams[1:]:
        key = (key << bits) | g
    return np.argsort(key, kind="stable")


def gram_answers(rows: DataFrame, frequent: int) -> DataFrame:
    """Quantised counts of every block's pairs and triples, in its order, out of the shard's trie."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _answer_table([])
        shard, kind = key[0].as_py(), table.column("kind")[0].as_py()
        counts = [unpack_numbers(x.as_py()) for x in table.column("counts")]
        edge = np.append(0, np.cumsum([len(c) for c in counts]))
        count = np.concatenate(counts).astype(np.int64)
        own = [np.frombuffer(x.as_py(), U) for x in table.column("keys")]
        rare, words = pd.factorize(np.concatenate(own))
        start = np.append(0, np.cumsum([len(k) for k in own]))
        parts = []
        for k, x in enumerate(table.column("places")):
            place = np.stack(unpack_grams(x.as_py(), 2 if kind == PAIRS else 3))
            far = place >= frequent
            place[far] = frequent + rare[start[k] + place[far] - frequent]
            parts.append(place.astype(np.int32))
        grams = list(np.concatenate(parts, axis=1))
        del parts
        size = frequent + len(words)
        order = _gram_order(grams, size)
        grams = [g[order] for g in grams]
        first, _ = run_lengths(*grams)
        grams = [g[first] for g in grams]
        total = np.add.reduceat(count[order], first)
        known = total > 0
        trie = NgramTrie([g[known] for g in grams], quantise(total[known]), size)
        code = np.zeros(len(order), np.int64)
        code[order] = np.repeat(trie.find(grams), np.diff(np.append(first, len(order))))
        return _answer_table([(b, shard, kind, pack_numbers(code[x:y]), None)
                              for b, x, y in zip(table.column("block").to_pylist(), edge[:-1], edge[1:])])
    return rows.groupBy("shard").applyInArrow(run, ANSWER)


def text_rows(docs: DataFrame, block_bytes: int, sent) -> DataFrame:
    """One row of every block: its texts' ids and sizes, the slots of all tokens, the words."""
    def run(batches):
        for block, ids, _, b in _blocks(batches, block_bytes, Frequent(*sent.value)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([ids], pa.list_(pa.int64())),
                 *[pa.array([x], pa.binary()) for x in (pack_numbers(b.sizes), pack_numbers(b.slots), b.words.tobytes())]],
                ["block", "doc_id", "sizes", "slots", "words"])
    return docs.mapInArrow(run, "block long, doc_id array<long>, sizes binary, slots binary, words binary")


def score_blocks(texts: DataFrame, found: DataFrame, shards: int, tokens: int, distinct: int, order: int) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score of every text."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        words, slots, sizes = (left.column(c)[0].as_py() for c in ("words", "slots", "sizes"))
        words, slots, sizes = np.frombuffer(words, U), unpack_numbers(slots).astype(np.int64), unpack_numbers(sizes).astype(np.int64)
        b = Block.of_slots(words, slots, sizes)
        u, w, _, pair = b.pairs()
        word_count, code = np.zeros(len(words), np.int64), np.zeros(len(u), np.int64)
        got = {(s, k): c for s, k, c in zip(right.column("shard").to_pylist(), right.column("kind").to_pylist(),
                                             right.column("counts"))}
        for s, place in b.word_runs(shards):
            word_count[place] = unpack_numbers(got[s, WORDS].as_py())
        for s, place in _runs(b.pair_shards(u, w, shards)):
            code[place] = unpack_numbers(got[s, PAIRS].as_py())
        p_word = (word_count + 1) / (tokens + distinct + 1)
        # the begin mark stands before every text, as the end behind it
        context = word_count.copy()
        context[b.begin] = word_count[b.slot(END)]
        p = ((restore(code) + MU * p_word[w]) / (context[u] + MU))[pair]
        if order > 2:
            x, y, z, _, triple, inner = b.triples(u, w, pair)
            code3 = np.zeros(len(x), np.int64)
            for s, place in _runs(b.triple_shards(x, y, z, shards)):
                code3[place] = unpack_numbers(got[shards + s, TRIPLES].as_py())
            p[inner] = (restore(code3)[triple] + MU * p[inner]) / (restore(code)[pair[inner - 1]] + MU)
        first = np.cumsum(sizes) - sizes
        return pa.table([
            left.column("doc_id").combine_chunks().flatten(), pa.array(sizes),
            pa.array(np.add.reduceat((word_count[slots] > 0).astype(np.int64), first)),
            pa.array(np.add.reduceat(np.log10(p_word)[slots], first)), pa.array(np.add.reduceat(np.log10(p), first))],
            ["doc_id", "n_tokens", "n_known", "base_score", "score"])
    return (texts.groupBy("block").cogroup(found.groupBy("block"))
            .applyInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double"))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    block_bytes: int = 8 << 20, order: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (of the model of ``order``)
    of every text; ids with crc32 remainder 2 modulo 7 are not learned from."""
    spark = docs.sparkSession
    out = F.coalesce(id_remainder(F.col("doc_id"), 7) == 2, F.lit(False))
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    d = d.select("doc_id", "text", (F.col("doc_id").isNotNull() & ~out).alias("learn"))
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // SHARD_BYTES)
    folder = Folder(spark, "lm")
    counted = folder.keep(word_answers(word_rows(d, block_bytes, shards), shards), "words", free=True)
    tokens = distinct = 0
    words, counts = [np.zeros(0, U)], [np.zeros(0, np.int64)]
    for r in counted.where(F.col("kind") == TOTALS).select("counts", "words").collect():  # one row per shard
        n = np.frombuffer(bytes(r.counts), np.int64)
        tokens, distinct = tokens + int(n[0]), distinct + int(n[1])
        words.append(np.frombuffer(bytes(r.words), U))
        counts.append(n[2:])
    words, counts = np.concatenate(words), np.concatenate(counts)
    words = words[np.lexsort((words, -counts))]
    number = np.argsort(words)
    sent = spark.sparkContext.broadcast((words[number], number))
    grams = folder.keep(gram_answers(gram_rows(d, block_bytes, shards, order, sent), len(words)), "grams", free=True)
    found = counted.where(F.col("kind") != TOTALS).union(grams).drop("words")
    scored = score_blocks(text_rows(d, block_bytes, sent), found, shards, tokens, distinct, order)
    return scored.select("doc_id", out.alias("held_out"), "n_tokens", "n_known",
                         F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
