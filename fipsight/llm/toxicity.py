"""Toxicity by a classifier chain of sparse linear models with out-of-fold probabilities.

The categories form a chain. The model of a category sees the words of a text (presence of each
word, A-Z lower-cased, and of its first bytes, which stand for its inflections) and the
probabilities of all earlier categories. For training, these probabilities come from models that
have not seen the row: the sample is dealt to ``FOLDS`` folds by id, and each fold is predicted by a
model of the others. Prediction runs the chain with the models of the whole sample.

Each model is fitted with FTRL and an L1 term that leaves only words that matter, so one toxic word
counts the same in a long text as in a short one. Features are exact 64-bit hashes, looked up by
binary search; a model holds at most the features of the bounded sample.

Cases: null or blank text has no word and gets the probabilities of the bias; a document without
labels is scored only; ids with remainder 1 and null ids are never learned from; without any usable
label all probabilities are 0.5; empty table = no rows; repeated rows are scored each; clashing extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fipsight.llm.linear import ftrl_train, sigmoid
from fipsight.llm.samples import id_remainder, sampled_labels
from fipsight.llm.text import SEPARATORS, _edges, chunks, lower_table, mix, run_lengths, span_hashes

U = np.uint64
FOLDS = 3
STEMS = (4, 5, 6)  # bytes of a word's beginning
LEAST_TEXTS = 2  # sample texts that must hold a feature, at least
KEEP = 0.4  # features that a training visit sees: one toxic word must do, without the others of its text


def _letter_bytes() -> np.ndarray:
    t = np.zeros(256, bool)
    t[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
    return t


def word_features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, text index) of the words, word beginnings and runs of signs of a chunk, of repeated
    and of all-capital words; distinct within each text."""
    low, letter = lower_table()[data], _letter_bytes()
    st, en = _edges(letter[data], off)
    doc = np.searchsorted(off, st, "right") - 1
    keys, docs = [span_hashes(low, st, en)], [doc]
    word = keys[0]
    again = doc[1:][(word[1:] == word[:-1]) & (doc[1:] == doc[:-1])]
    capital = np.append(0, np.cumsum((data >= 65) & (data <= 90)))
    loud = doc[(en - st > 1) & (capital[en] - capital[st] == en - st)]
    letter[[*SEPARATORS, *range(48, 58)]] = True  # what is left are signs
    ss, se = _edges(~letter[data], off)
    keys += [mix(span_hashes(low, ss, se) + U(1)), np.full(len(again), 2, U), np.full(len(loud), 3, U)]
    docs += [np.searchsorted(off, ss, "right") - 1, again, loud]
    for n in STEMS:
        long = en - st > n
        keys.append(mix(span_hashes(low, st[long], st[long] + n) + U(n)))
        docs.append(doc[long])
    key, doc = np.concatenate(keys), np.concatenate(docs)
    order = np.lexsort((key, doc))
    key, doc = key[order], doc[order]
    first, _ = run_lengths(doc, key)
    return key[first], doc[first]


def chain_key(category: int) -> np.ndarray:
    """Feature that carries the probability of an earlier category."""
    return mix(np.array([category], U) + U(0xC4A1))


class Model:
    """Sorted features, their weights and the bias."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, bias: float):
        self.keys, self.weights, self.bias = keys, weights, bias

    def of(self, key: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(key))
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.weights[at], 0.0)

    def predict(self, key: np.ndarray, doc: np.ndarray, earlier: list[np.ndarray], n: int) -> np.ndarray:
        total = np.bincount(doc, self.of(key), minlength=n) + self.bias
        for c, p in enumerate(earlier):
            total = total + self.of(chain_key(c))[0] * p
        return sigmoid(total)


def sample_rows(docs: DataFrame, labels: DataFrame, names: list[str]) -> DataFrame:
    """fold, y (label array), keys (packed features), earlier (empty) of the labelled sample."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in chunks(batch.column(2)):
                key, doc = word_features(data, off)
                edge = np.searchsorted(doc, np.arange(j - i + 1))
                rows = [key[a:b].tobytes() for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(rows, pa.binary()),
                     pa.array([[]] * (j - i), pa.list_(pa.float64()))], ["fold", "y", "keys", "earlier"])

    # at most max_rows ids with their labels, hence the broadcast
    return (docs.join(F.broadcast(labels), "doc_id")
            .select(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(FOLDS)).cast("int").alias("fold"),
                    F.array(*[F.col(c).cast("double") for c in names]).alias("y"), "text")
            .mapInArrow(run, "fold int, y array<double>, keys binary, earlier array<double>"))


def fit_models(rows: DataFrame, category: int) -> dict[int, Model]:
    """Models of one category: number f < FOLDS has not seen fold f, number FOLDS has seen all rows."""
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        own = [np.frombuffer(k, U) for k in pdf["keys"]]
        used, n = np.unique(np.concatenate([np.zeros(0, U), *own]), return_counts=True)
        used = used[n >= LEAST_TEXTS]
        extra = np.concatenate([np.zeros(0, U), *[chain_key(c) for c in range(category)]])
        size = len(used)
        index, value = [], []
        for k, before in zip(own, pdf["earlier"]):
            at = np.minimum(np.searchsorted(used, k), max(size - 1, 0))
            at = at[used[at] == k] if size else at[:0]
            index.append(np.concatenate([at, size + np.arange(category + 1)]).astype(np.int32))
            value.append(np.concatenate([np.ones(len(at)), np.asarray(before, float), [1.0]]).astype(np.float32))
        w = ftrl_train(index, value, np.array([y[category] for y in pdf["y"]]), size + category + 1, alpha=1.0,
                       l1=4.0, l2=0.01, epochs=10, keep=KEEP)
        keep = np.flatnonzero(w[:-1])
        keys = np.append(np.concatenate([used, extra])[keep], U(0))
        return pd.DataFrame({"model": int(pdf["model"].iloc[0]), "bias": np.append(np.zeros(len(keep), bool), True),
                             "key": keys.view(np.int64), "weight": np.append(w[keep], w[-1])})

    seen = F.filter(F.array(*[F.lit(k) for k in range(FOLDS + 1)]), lambda m: m != F.col("fold"))
    got = (rows.withColumn("model", F.explode(seen)).groupBy("model")
           .applyInPandas(fit, "model int, bias boolean, key long, weight double")).toPandas()
    out = {}
    for m in range(FOLDS + 1):
        g = got[(got["model"] == m) & ~got["bias"].astype(bool)]
        keys = g["key"].to_numpy(np.int64).view(U)
        order = np.argsort(keys)
        bias = got[(got["model"] == m) & got["bias"].astype(bool)]["weight"].sum()
        out[m] = Model(keys[order], g["weight"].to_numpy(float)[order], float(bias))
    return out


def add_out_of_fold(rows: DataFrame, models: dict[int, Model]) -> DataFrame:
    """Append each row's probability by the model that has not seen it to ``earlier``."""
    sent = rows.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = []
            for fold, keys, before in zip(pdf["fold"], pdf["keys"], pdf["earlier"]):
                k = np.frombuffer(keys, U)
                p = sent.value[fold].predict(k, np.zeros(len(k), np.int64), [np.array([x]) for x in before], 1)
                done.append([*map(float, before), float(p[0])])
            yield pdf.assign(earlier=done)
    return rows.mapInPandas(run, rows.schema)


def fit_chain(docs: DataFrame, labels: DataFrame, names: list[str]) -> list[Model]:
    """Final models of the categories, in the order of the chain."""
    rows, chain = sample_rows(docs, labels, names), []
    for c in range(len(names)):
        models = fit_models(rows, c)
        chain.append(models[FOLDS])
        if c + 1 < len(names):
            rows = add_out_of_fold(rows, models)
    return chain


def score_chain(docs: DataFrame, chain: list[Model], names: list[str]) -> DataFrame:
    """doc_id and one probability ``<category>_score`` for each category."""
    sent = docs.sparkSession.sparkContext.broadcast(chain)
    out = [f"{c}_score" for c in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in chunks(batch.column(1), 1 << 18):
                key, doc = word_features(data, off)
                p: list[np.ndarray] = []
                for model in sent.value:
                    p.append(model.predict(key, doc, p, j - i))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *map(pa.array, p)], ["doc_id", *out])
    return docs.select("doc_id", "text").mapInArrow(run, ", ".join(["doc_id long", *[f"`{c}` double" for c in out]]))


def classify_toxicity(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], max_rows: int = 12_000,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, a score and a 0/1 prediction for each category of the chain."""
    names = list(categories)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    learn = sampled_labels(labels, categories, id_remainder(F.col("doc_id"), 3) != 1, max_rows)
    scored = score_chain(d, fit_chain(d, learn, names), names)
    return scored.select("doc_id", F.coalesce(id_remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
                         *[f"{c}_score" for c in names], *[(F.col(f"{c}_score") >= 0.5).cast("int").alias(c) for c in names])
