"""Quality classifier: hashed word n-gram logistic regression (FTRL), scored as sparse dot products.

Tokens are runs of letters and digits (A-Z lower-cased) and runs of other signs. Features, hashed
into ``dims`` places: tokens, their letter case or kind, pairs of neighbouring tokens and of kinds;
a token that repeats its neighbour is written as a back reference, so that repetition is one
feature whatever the word. A feature's value is its share of the document's tokens, times a
constant; a score is the logistic of one sparse dot product, whatever the text's length.

Training takes a bounded sample of labelled documents (``max_rows``), dealt to shards of about
``SHARD_ROWS`` rows; each shard runs the updates on its rows, and the shards' weights are averaged.
The model is one array of ``dims`` weights.

Cases: null or blank text has no feature and gets the score of the bias; a document without a
matching label is scored only; a null id is scored, never learned from; repeated rows are scored
each; no usable label at all gives 0.5 everywhere; empty table = no rows; clashing extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fipsight.llm.linear import ftrl_train, pack_row, sigmoid, unpack_row
from fipsight.llm.samples import id_remainder, sampled_labels
from fipsight.llm.text import _edges, chunks, lower_table, mix, ngram_hashes, span_hashes

U = np.uint64
DIMS = 1 << 18
SCALE = 16.0  # feature values are SCALE x share of the tokens
SHARD_ROWS = 2500  # rows that one trainer sees


def _byte_kinds() -> np.ndarray:
    """0 blank, 1 sign, 2 letter or digit (any byte of a non-ASCII character too)."""
    t = np.ones(256, np.uint8)
    t[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
    t[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 2
    return t


def token_features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of every feature occurrence of a chunk of texts."""
    kind = _byte_kinds()[data]
    ws, we = _edges(kind == 2, off)
    ss, se = _edges(kind == 1, off)
    low = lower_table()[data]
    upper = np.append(0, np.cumsum((data >= 65) & (data <= 90)))
    lower = np.append(0, np.cumsum((data >= 97) & (data <= 122)))
    up, lo = upper[we] - upper[ws], lower[we] - lower[ws]
    case = np.where(up == 0, 1, np.where((lo == 0) & (up > 1), 2, np.where(up == 1, 3, 4))).astype(U)
    st = np.concatenate([ws, ss])
    order = np.argsort(st, kind="stable")
    token = np.concatenate([span_hashes(low, ws, we), span_hashes(low, ss, se)])[order]
    shape = np.concatenate([case, mix(span_hashes(low, ss, se) + U(77))])[order]
    doc = np.searchsorted(off, st[order], "right") - 1
    pair, pair_doc = ngram_hashes(token, doc, 2)
    same = (token[1:] == token[:-1])[doc[1:] == doc[:-1]]
    pair = np.where(same, U(99), pair)
    shapes, _ = ngram_hashes(shape, doc, 2)
    return (np.concatenate([mix(token + U(1)), mix(shape + U(2)), mix(pair + U(3)), mix(shapes + U(4))]),
            np.concatenate([doc, doc, pair_doc, pair_doc]))


def _share(doc: np.ndarray, n: int) -> np.ndarray:
    """Value of one occurrence in each document."""
    return SCALE / np.maximum(np.bincount(doc, minlength=n), 1)


def training_rows(docs: DataFrame, labels: DataFrame, shards: int) -> DataFrame:
    """shard, label, row (packed features) of the documents of a bounded label sample."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in chunks(batch.column(2)):
                key, doc = token_features(data, off)
                at = (key % U(DIMS - 1)).astype(np.int64)
                value = _share(doc, j - i)
                order = np.argsort(doc, kind="stable")
                at, edge = at[order], np.searchsorted(doc[order], np.arange(j - i + 1))
                rows = []
                for k in range(j - i):
                    index, n = np.unique(at[edge[k]:edge[k + 1]], return_counts=True)
                    rows.append(pack_row(np.append(index, DIMS - 1), np.append(n * value[k], 1.0)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i),
                                                  pa.array(rows, pa.binary())], ["shard", "label", "row"])

    # the sample is at most max_rows ids and labels, hence the broadcast
    return (docs.join(F.broadcast(labels), "doc_id")
            .select(F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard"),
                    F.col("label").cast("double").alias("label"), "text")
            .mapInArrow(run, "shard int, label double, row binary"))


def train(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Weights averaged over the shards; at most ``DIMS`` numbers come back to the driver."""
    shards = max(1, labels.count() // SHARD_ROWS)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pairs = [unpack_row(r) for r in pdf["row"]]
        w = ftrl_train([p[0] for p in pairs], [p[1] for p in pairs], pdf["label"].to_numpy(), DIMS,
                       alpha=1.0, epochs=5)
        at = np.flatnonzero(w)
        return pd.DataFrame({"place": at, "weight": w[at]})

    rows = (training_rows(docs, labels, shards).groupBy("shard").applyInPandas(fit, "place long, weight double")
            .groupBy("place").agg((F.sum("weight") / shards).alias("weight")).collect())
    out = np.zeros(DIMS)
    for r in rows:
        out[r.place] = r.weight
    return out


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, score of all documents."""
    model = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = model.value
            for i, j, data, off in chunks(batch.column(1), 1 << 18):
                key, doc = token_features(data, off)
                total = np.bincount(doc, w[(key % U(DIMS - 1)).astype(np.int64)], minlength=j - i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(sigmoid(total * _share(doc, j - i) + w[DIMS - 1]))],
                    ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5, max_rows: int = 20_000, id_col: str = "doc_id",
              text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """The rows of ``docs``, all columns, whose score is at least ``least``; learns as ``classify``."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    learn = sampled_labels(labels, {"label": F.col(label_col).cast("int")}, id_remainder(F.col("doc_id"), 3) != 1,
                           max_rows)
    model = docs.sparkSession.sparkContext.broadcast(train(d, learn))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = model.value
            for i, j, data, off in chunks(batch.column(at), 1 << 18):
                key, doc = token_features(data, off)
                total = np.bincount(doc, w[(key % U(DIMS - 1)).astype(np.int64)], minlength=j - i)
                good = sigmoid(total * _share(doc, j - i) + w[DIMS - 1]) >= least
                yield batch.slice(i, j - i).filter(pa.array(good))
    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """doc_id, held_out, score, predicted of every document; ids with remainder 1 are never learned from."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    learn = sampled_labels(labels, {"label": F.col(label_col).cast("int")}, id_remainder(F.col("doc_id"), 3) != 1,
                           max_rows)
    scored = score(d, train(d, learn))
    return scored.select("doc_id", F.coalesce(id_remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
