"""Benchmark decontamination by winnowing.

Words are runs of ASCII letters and digits (A-Z lower-cased) and non-ASCII characters. An item's windows
are its runs of ``span`` consecutive words; an item of fewer words is one window. A document word is hit
when it lies inside an occurrence of a window.

1. Winnowing. The k-gram hashes of a text pass a sliding window of w = span - k + 1 places, of which each
   keeps its least hash (the last of equal ones). What a window keeps depends on its ``span`` words
   alone, so two texts that share ``span`` words share a kept hash at the same place in them: every shared
   span is found, from about 2 / (w + 1) of the hashes. Items shorter than ``span`` are winnowed at their
   own length, and so are the documents for each such length that occurs.
2. Join. The items' fingerprints are the test side. Documents keep those of their fingerprints whose hash
   occurs there (a broadcast array of hashes while there are at most MOST_HASHES of them; beyond, all
   fingerprints go to the join), each with the span - k words before it and span words from it on. Texts
   of the same words are joined once.
3. Extension. A joined pair is compared word by word to both sides; that settles the k words themselves
   and gives the shared span around them. Spans of at least ``span`` words (a short item: all its words)
   are hits: a span's words and the items it comes from. Nothing more is needed, since each occurrence
   of a window holds a kept hash whose surroundings reach over the whole window.

Cases: a null or wordless document has no words; a null or wordless item has no window; an item without
an id still marks words but is not named; rows of one item_id are one item; repeated documents get a row
each; very long texts are handled in their row; documents shorter than a window can only hold shorter
items; empty tables = no rows, or no hits; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fipsight.llm.neardup import text_keys
from fipsight.llm.store import Folder
from fipsight.llm.text import _edges, chunks, lower_table, mix, span_hashes

U = np.uint64
SPAN = 10
MOST_HASHES = 4_000_000  # 32 MB
BEFORE_TEXT, BEFORE_ITEM = U(0), U(1)  # beyond the ends of a document, of an item


def words_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of the words of a chunk of texts."""
    ok = np.zeros(256, bool)
    ok[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
    data = lower_table()[data]
    st, en = _edges(ok[data], off)
    return span_hashes(data, st, en), np.searchsorted(off, st, "right") - 1


def gram_size(span: int) -> int:
    return (span + 1) // 2


def winnow(words: np.ndarray, doc: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, k-gram hash) of the kept fingerprints: the last least hash of every window of
    span - k + 1 k-grams that lies inside one text."""
    k = gram_size(span)
    w = span - k + 1
    m = len(words) - span + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    n = len(words) - k + 1
    gram = mix(words[:n] + U(span))
    for j in range(1, k):
        gram = mix(gram * U(0x9E3779B97F4A7C15) + words[j:j + n])
    least, place = gram[:m].copy(), np.arange(m)
    for j in range(1, w):
        new = gram[j:j + m]
        less = new <= least
        least[less] = new[less]
        place[less] = np.flatnonzero(less) + j
    place = place[doc[:m] == doc[span - 1:]]
    if len(place):
        place = place[np.append(True, place[1:] != place[:-1])]  # places never fall
    return place, gram[place]


def surroundings(words: np.ndarray, doc: np.ndarray, place: np.ndarray, span: int, beyond: np.uint64) -> np.ndarray:
    """Word hashes around each place: span - k before it, span from it on; ``beyond`` outside the text."""
    at = place[:, None] + np.arange(gram_size(span) - span, span)
    inside = (at >= 0) & (at < len(words))
    at = np.where(inside, at, 0)
    inside &= doc[at] == doc[place][:, None]
    return np.where(inside, words[at], beyond)


def _binary(rows: np.ndarray) -> pa.Array:
    """One binary value for each row of a matrix of 64-bit words."""
    n, width = rows.shape
    raw = np.ascontiguousarray(rows.astype("<u8")).tobytes()
    return pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * (8 * width)),
                                                        pa.py_buffer(raw)])


def item_fingerprints(items: DataFrame, span: int) -> DataFrame:
    """hash, around, span, items: distinct fingerprints with their surroundings and the items that hold them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in chunks(batch.column(1)):
                words, doc = words_of(data, off)
                count = np.bincount(doc, minlength=j - i)
                for t in np.unique(np.minimum(count[count > 0], span)).tolist():
                    own = np.minimum(count, span)[doc] == t
                    place, gram = winnow(words[own], doc[own], t)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(i, j - i).take(pa.array(doc[own][place])), pa.array(gram.view(np.int64)),
                         _binary(surroundings(words[own], doc[own], place, t, BEFORE_ITEM)),
                         pa.array(np.full(len(place), t, np.int32))], ["item", "hash", "around", "span"])

    each = items.mapInArrow(run, "item string, hash long, around binary, span int")
    return each.groupBy("hash", "around", "span").agg(F.collect_set("item").alias("items"))


def document_candidates(docs: DataFrame, spans: list[int], known=None) -> DataFrame:
    """doc_id, key (of the word sequence), n_words and candidates: fingerprints (hash, place, around) of
    every document, those in the sorted broadcast array ``known`` if given."""
    kind = pa.struct([("hash", pa.int64()), ("place", pa.int64()), ("around", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in chunks(batch.column(1)):
                words, doc = words_of(data, off)
                key, count = text_keys(words, doc, j - i)
                other, _ = text_keys(mix(words ^ U(0xA5A5A5A5A5A5A5A5)), doc, j - i)
                first = np.cumsum(count) - count
                owner, place, gram, around = [], [], [], []
                for t in spans:
                    p, g = winnow(words, doc, t)
                    if known is not None:
                        have = known.value
                        at = np.minimum(np.searchsorted(have, g), max(len(have) - 1, 0))
                        keep = have[at] == g if len(have) else np.zeros(len(g), bool)
                        p, g = p[keep], g[keep]
                    owner.append(doc[p])
                    place.append(p - first[doc[p]])
                    gram.append(g)
                    around.append(_binary(surroundings(words, doc, p, t, BEFORE_TEXT)))
                owner = np.concatenate([np.zeros(0, np.int64), *owner])
                order = pa.array(np.argsort(owner, kind="stable"))
                cells = [pa.array(np.concatenate([np.zeros(0, U), *gram]).view(np.int64)),
                         pa.array(np.concatenate([np.zeros(0, np.int64), *place])),
                         pa.concat_arrays([pa.array([], pa.binary()), *around])]
                found = pa.StructArray.from_arrays([c.take(order) for c in cells], fields=list(kind))
                edge = np.append(0, np.cumsum(np.bincount(owner, minlength=j - i))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), _binary(np.stack([key, other], 1)), pa.array(count.astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(edge), found)], ["doc_id", "key", "n_words", "candidates"])

    return docs.mapInArrow(run, "doc_id long, key binary, n_words long, "
                                "candidates array<struct<hash: long, place: long, around: binary>>")


def extended(pairs: DataFrame) -> DataFrame:
    """key, start, end, items of the joined fingerprints whose shared words reach ``span``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(2).to_numpy()
            for t in np.unique(spans).tolist():
                rows = batch.filter(pa.array(spans == t))
                k, width = gram_size(t), 2 * t - gram_size(t)
                mine, theirs = (np.frombuffer(b"".join(rows.column(c).to_pylist()), "<u8").reshape(-1, width) for c in (3, 4))
                same = mine == theirs
                left = np.minimum.accumulate(same[:, t - k - 1::-1] if t > k else same[:, :0], axis=1).sum(1)
                right = np.minimum.accumulate(same[:, t - k:], axis=1).sum(1)
                place = rows.column(1).to_numpy()
                out = pa.RecordBatch.from_arrays([rows.column(0), pa.array(place - left), pa.array(place + right), rows.column(5)],
                                                 ["key", "start", "end", "items"])
                yield out.filter(pa.array((right >= k) & (left + right >= t)))

    return pairs.select("key", "place", "span", "around", "item_around", "items").mapInArrow(
        run, "key binary, start long, end long, items array<string>")


def decontaminate(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", most_hashes: int = MOST_HASHES) -> DataFrame:
    """doc_id, n_words, n_hit, items (ids as strings, sorted), spans (word ranges, merged only in n_hit)
    of every document."""
    spark = docs.sparkSession
    folder = Folder(spark, "decontaminate")
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    b = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    prints = folder.keep(item_fingerprints(b, span), "items")
    spans = sorted(r[0] for r in prints.select("span").distinct().collect())  # at most ``span`` numbers
    known, hashes = None, prints.select("hash").distinct()
    if hashes.count() <= most_hashes:
        have = np.sort(hashes.toArrow().column(0).to_numpy().view(U))
        known = spark.sparkContext.broadcast(have)
    rows = folder.keep(document_candidates(d, spans, known), "documents")
    some = F.size("candidates") > 0
    texts = rows.where(some).groupBy("key").agg(F.first("candidates").alias("candidates"))
    pairs = (texts.select("key", F.inline("candidates"))
             .join(prints.withColumnRenamed("around", "item_around"), "hash"))
    by_text = extended(pairs).groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans"),
                                                 F.flatten(F.collect_set("items")).alias("items"))
    hits = by_text.select("key", F.array_sort("spans").alias("spans"), F.array_sort(F.array_distinct("items")).alias("items"))
    hit = rows.where(some).join(hits, "key", "left").select("doc_id", "n_words", "spans", "items")
    none = rows.where(~some).select("doc_id", "n_words", F.lit(None).cast(hits.schema["spans"].dataType).alias("spans"),
                                    F.lit(None).cast("array<string>").alias("items"))
    out = hit.unionByName(none)
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach"))
    covered = F.aggregate("spans", zero, lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["reach"], s["start"]))).alias("n"),
        F.greatest(a["reach"], s["end"]).alias("reach")), lambda a: a["n"])
    return out.select("doc_id", "n_words", F.coalesce(covered, F.lit(0)).alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans")


def contamination_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))
