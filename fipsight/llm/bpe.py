"""Byte-level BPE of whole texts by one global shuffle of distinct words, and decoding.

Texts are split into pre-tokens with positions. A block (a run of a task's rows of about
``block_bytes``) names each of its distinct words by a slot and keeps every text as the array of the
slots in order of position. The distinct words of all blocks are shuffled by word: a word belongs to
the bucket of its hash, and a block sends each bucket one row with the words it holds of it. A
bucket encodes each distinct word once and sends every block the ids of its slots; each block puts
its texts together again by position. A word stands once in each block, so a word that is everywhere
is one entry per block, never one per occurrence, and every shuffled row is bounded by the block
size (or by one text that is longer). Rows are compressed: words and slots are small numbers.

Both branches split the same rows, so ``docs`` must be deterministic (a table scan); after an
operation that deals rows at random, write it first.

Decoding joins ids with the byte strings of the vocabulary (one entry per token id).

Cases: null text = empty text = no ids; empty table = no rows; repeated rows are encoded each; very
long texts are one block; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fipsight.llm.pretokens import WordTable, split_words
from fipsight.llm.text import byte_column, chunks, gather_spans, worker_cache

U = np.uint64


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id of a rank file (base64 token, blank, rank on every line)."""
    import base64
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _piece_encoder(path: str, pattern: str):
    def build():
        import tiktoken
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})
    return worker_cache("ranks:" + path, build)


def _spans_table(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, lengths) of a list of byte strings."""
    n = np.array([len(v) for v in values], np.int64)
    return np.frombuffer(b"".join(values), np.uint8), np.cumsum(n) - n, n


def _token_bytes(path: str):
    """Byte strings of the vocabulary by id."""
    def build():
        ranks = load_ranks(path)
        out = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            out[i] = token
        return _spans_table(out)
    return worker_cache("bytes:" + path, build)


def _pack(x: np.ndarray) -> bytes:
    """Compressed 32-bit numbers, by byte plane since most are small."""
    planes = np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
    return _squeeze(planes)


def _unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(_expand(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def _squeeze(raw: bytes) -> bytes:
    """Length (4 bytes), then the compressed bytes."""
    return len(raw).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _expand(raw: bytes) -> bytes:
    size = int.from_bytes(raw[:4], "little")
    return pa.decompress(raw[4:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int):
    """Yield (block id, [(first row, bytes, offsets), ...], ids of the rows) with about block_bytes each."""
    base, k = TaskContext.get().partitionId() << 31, 0
    parts, rows, size = [], [], 0
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for i, j, data, off in chunks(batch.column(1)):
            parts.append((data, off))
            rows.append(ids[i:j])
            size += len(data)
            if size >= block_bytes:
                yield base + k, parts, rows
                parts, rows, size, k = [], [], 0, k + 1
    if parts:
        yield base + k, parts, rows


def _slots(parts):
    """Slots of a block: yields for each part (slots by position, offsets by text, spans, hashes and
    slots of the words that are new), frequent words first."""
    table = WordTable()
    for data, off in parts:
        st, en, first, keys, inverse = split_words(data, off)
        slot = table.find(keys)
        new = np.flatnonzero(slot < 0)
        slots = table.add(keys[new])
        rank = np.empty(len(new), np.int64)  # of the new words by falling count
        rank[np.argsort(-np.bincount(inverse, minlength=len(keys))[new], kind="stable")] = np.arange(len(new))
        table.rename(keys[new], slots[0] + rank if len(new) else slots)
        slot[new] = table.find(keys[new])
        yield slot[inverse], np.searchsorted(st, off), (st[first[new]], en[first[new]], keys[new], slot[new])


def block_words(docs: DataFrame, block_bytes: int, buckets: int) -> DataFrame:
    """bucket, block, slots, words: the distinct pre-tokens of each block, one row per bucket.
    ``slots`` are differences, ``words`` the lengths and the bytes of the words."""
    def run(batches):
        for block, parts, _ in _blocks(batches, block_bytes):
            spans, keys, slots, base, raw = [], [], [], 0, []
            for (data, _), (_, _, (a, b, key, slot)) in zip(parts, _slots(parts)):
                flat, off = gather_spans(data, a, b - a)
                raw.append(flat)
                spans.append(np.stack([off[:-1] + base, off[1:] - off[:-1]]))
                base += len(flat)
                keys.append(key)
                slots.append(slot)
            if not base:
                continue
            (at, size), slot = np.concatenate(spans, 1), np.concatenate(slots)
            bucket = (np.concatenate(keys) % U(buckets)).astype(np.int64)
            order = np.lexsort((slot, bucket))
            at, size, slot, bucket = at[order], size[order], slot[order], bucket[order]
            flat, off = gather_spans(np.concatenate(raw), at, size)
            edge = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
            rows = []
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                rows.append((int(bucket[a]), block, _pack(np.diff(slot[a:b], prepend=0)), _pack(size[a:b]),
                             _squeeze(flat[off[a]:off[b]].tobytes())))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)],
                                             ["bucket", "block", "slots", "sizes", "words"])
    return docs.mapInArrow(run, "bucket long, block long, slots binary, sizes binary, words binary")


def block_texts(docs: DataFrame, block_bytes: int) -> DataFrame:
    """block, doc_id, slots: every text as the slots of its pre-tokens in order of position."""
    def run(batches):
        for block, parts, rows in _blocks(batches, block_bytes):
            for ids, (slots, edge, _) in zip(rows, _slots(parts)):
                packed = [_pack(slots[a:b]) for a, b in zip(edge[:-1], edge[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), block)), pa.array(ids, pa.int64()), pa.array(packed, pa.binary())],
                    ["block", "doc_id", "slots"])
    return docs.mapInArrow(run, "block long, doc_id long, slots binary")


def encode_words(words: DataFrame, ranks: str, pattern: str, buckets: int, keep: int = 1_000_000) -> DataFrame:
    """block, slots, counts, ids: each distinct word of a bucket is encoded once, its ids go to every
    block that holds it. ``keep`` bounds the memory of the bucket's dictionary, which then starts anew."""
    def run(batches):
        known: dict[bytes, bytes] = {}
        for batch in batches:
            enc = _piece_encoder(ranks, pattern)._core_bpe
            counts, ids = [], []
            for sizes, packed in zip(batch.column(3), batch.column(4)):
                raw, out, at = _expand(packed.as_py()), [], 0
                for n in _unpack(sizes.as_py()).tolist():
                    word = raw[at:at + n]
                    at += n
                    got = known.get(word)
                    if got is None:
                        if len(known) >= keep:
                            known.clear()
                        got = known[word] = np.array(enc.encode_single_piece(word), "<u4").tobytes()
                    out.append(got)
                counts.append(_pack(np.array([len(x) // 4 for x in out])))
                ids.append(_pack(np.frombuffer(b"".join(out), "<u4")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(counts, pa.binary()), pa.array(ids, pa.binary())],
                ["block", "slots", "counts", "ids"])
    return (words.repartition(buckets, "bucket")
            .mapInArrow(run, "block long, slots binary, counts binary, ids binary"))


def assemble(texts: DataFrame, word_ids: DataFrame) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit): the slots of each text replaced by their ids."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        def joined(name):
            return [np.zeros(0, np.int64), *[_unpack(x.as_py()) for x in right.column(name)]]
        slot = np.concatenate([np.cumsum(x) for x in joined("slots")]).astype(np.int64)
        count = np.concatenate(joined("counts")).astype(np.int64)
        flat = np.concatenate(joined("ids")).astype("<u4")
        start, n = np.zeros(len(slot), np.int64), np.zeros(len(slot), np.int64)
        start[slot], n[slot] = np.cumsum(count) - count, count
        out = []
        for x in left.column("slots"):
            s = _unpack(x.as_py())
            out.append(gather_spans(flat, start[s], n[s])[0].tobytes())
        return pa.table([left.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "ids"])
    return (texts.groupBy("block").cogroup(word_ids.groupBy("block"))
            .applyInArrow(run, "doc_id long, ids binary"))


def encode_documents(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     block_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) of every text, without special tokens.

    ``ranks`` (path of the rank file) must be readable on every executor. There is one bucket of
    words per shuffle partition of the session."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return assemble(block_texts(docs, block_bytes),
                    encode_words(block_words(docs, block_bytes, buckets), ranks, pattern, buckets))


def decode_ids(raw: np.ndarray, edge: np.ndarray, ranks: str) -> list[bytes]:
    """Bytes of each run of packed ids, joined with the token-byte table."""
    flat, start, n = _token_bytes(ranks)
    out = []
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        ids = raw[a:b].view("<u4").astype(np.int64)
        out.append(gather_spans(flat, start[ids], n[ids])[0].tobytes())
    return out


def decode_documents(encoded: DataFrame, ranks: str) -> DataFrame:
    """Add ``decoded`` (bytes) to rows with ``ids`` by joining them with the token-byte table."""
    fields = encoded.schema.fields
    names = [f.name for f in fields] + ["decoded"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", decoded binary"
    at = [f.name for f in fields].index("ids")

    def run(batches):
        for batch in batches:
            out = decode_ids(*byte_column(batch.column(at)), ranks)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names)
    return encoded.mapInArrow(run, schema)


def encoding_digests(encoded: DataFrame, ranks: str) -> DataFrame:
    """doc_id, n_tokens, digest of the decimal ids joined by blanks, digest of the decoded bytes."""
    def run(batches):
        import hashlib
        for batch in batches:
            raw, edge = byte_column(batch.column(1))
            text, done = [], []
            for k in range(batch.num_rows):
                a, b = edge[k:k + 2].tolist()
                text.append(hashlib.sha256(" ".join(map(str, raw[a:b].view("<u4").tolist())).encode()).hexdigest())
                done.append(hashlib.sha256(decode_ids(raw, edge[k:k + 2], ranks)[0]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(edge) // 4), pa.array(text, pa.string()), pa.array(done, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return (encoded.select("doc_id", "ids")
            .mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))
