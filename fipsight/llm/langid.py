"""Language identification by multilingual mixture inference.

A document is a mixture of languages: each of its words (runs of letters, A-Z lower-cased) comes
from one language, with the likelihood of its byte trigrams (word edges included) in that language.
Expectation-maximisation estimates the document's proportions over all learned languages. Then the
language set is chosen by penalised likelihood among the nested sets of the 1, 2, ... largest
proportions: a further language stays only if the log-likelihood of the refitted mixture rises by
more than ``penalty`` times the logarithm of the number of words.

Trigram counts are taken from all learning documents (sums by language and trigram place, summed
per task before the shuffle); the model has ``PLACES`` numbers per language, whatever the corpus.

Cases: null text or text without a letter is ``und`` with score 0; a document with null language is
predicted, never learned from; ties go to the smaller language name; with no learning document at
all everything is ``und``; empty table = no rows; repeated rows are predicted each; clashing extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fipsight.llm.samples import id_remainder
from fipsight.llm.text import _edges, chunks, lower_table

PLACES = 1 << 18
ROUNDS = 12


def _letters() -> np.ndarray:
    t = np.full(256, 0x20, np.uint8)
    at = [*range(65, 91), *range(97, 123), *range(128, 256)]
    t[at] = lower_table()[at]
    return t


def word_trigrams(data: np.ndarray, off: np.ndarray):
    """(place of the trigram around each letter byte, first such byte of each word, text of each word)."""
    c = _letters()[data]
    inside = c != 0x20
    st, en = _edges(inside, off)
    wide = np.full(len(c) + 2, 0x20, np.uint32)
    wide[1:-1] = c
    left, right = wide[:-2].copy(), wide[2:].copy()
    left[st] = 0x20  # words never reach into the next text
    right[en - 1] = 0x20
    gram = ((left << 16) | (c.astype(np.uint32) << 8) | right)[inside]
    place = ((gram * np.uint32(0x9E3779B1)) >> np.uint32(14)).astype(np.int64)
    size = en - st
    return place, np.cumsum(size) - size, np.searchsorted(off, st, "right") - 1


def count_trigrams(docs: DataFrame) -> DataFrame:
    """lang, place, n over all rows of (lang, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(0).to_pylist()
            for i, j, data, off in chunks(batch.column(1)):
                place, first, doc = word_trigrams(data, off)
                if not len(place):
                    continue
                size = np.diff(np.append(first, len(place)))
                known = sorted(set(names[i:j]))
                code = np.array([known.index(x) for x in names[i:j]])
                each = np.repeat(code[doc], size)
                for k, name in enumerate(known):
                    sums = np.bincount(place[each == k], minlength=PLACES)
                    total[name] = total[name] + sums if name in total else sums
        for name, sums in total.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(sums[at])],
                                             ["lang", "place", "n"])

    return (docs.select("lang", "text").mapInArrow(run, "lang string, place long, n long")
            .groupBy("lang", "place").agg(F.sum("n").alias("n")))


def learn(docs: DataFrame, smooth: float = 0.5) -> tuple[list[str], np.ndarray]:
    """Language names in order and log-probabilities (place, language) of trigrams."""
    got = count_trigrams(docs).toPandas()
    names = sorted(got["lang"].unique())
    counts = np.zeros((PLACES, len(names)))
    counts[got["place"].to_numpy(), np.searchsorted(names, got["lang"])] = got["n"].to_numpy()
    used = max(1, int((counts.sum(1) > 0).sum()))
    return names, np.log((counts + smooth) / (counts.sum(0) + smooth * used)).astype(np.float32)


def _em(like: np.ndarray, doc: np.ndarray, first: np.ndarray, n: np.ndarray, allowed: np.ndarray, rounds: int):
    """(proportions, log-likelihood without the scale of ``like``) of each text's mixture of its
    allowed languages; texts are consecutive runs of words."""
    share = allowed / allowed.sum(1, keepdims=True)
    for _ in range(rounds):
        part = like * share[doc]
        part /= part.sum(1, keepdims=True)
        share = np.add.reduceat(part, first, axis=0) / n[:, None]
    value = np.add.reduceat(np.log((like * share[doc]).sum(1)), first)
    return share, value


def infer(place: np.ndarray, first: np.ndarray, doc: np.ndarray, model: np.ndarray, penalty: float):
    """(texts that have words, proportions over the chosen language sets)."""
    langs = model.shape[1]
    log = np.add.reduceat(model[place], first, axis=0, dtype=np.float64)
    like = np.exp(np.maximum(log - log.max(1, keepdims=True), -60.0))
    start = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    texts, n = doc[start], np.diff(np.append(start, len(doc)))
    row = np.repeat(np.arange(len(texts)), n)
    full, _ = _em(like, row, start, n.astype(float), np.ones((len(texts), langs)), ROUNDS)
    order = np.argsort(-full, axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")
    share = (rank == 0).astype(float)
    best = np.add.reduceat(np.log((like * share[row]).sum(1)), start)
    alive = np.flatnonzero(full[np.arange(len(texts)), order[:, 0]] < 1.0)
    size = 1
    while size < langs and len(alive):
        size += 1
        pick = np.zeros(len(texts), bool)
        pick[alive] = True
        words = np.flatnonzero(pick[row])
        sub_n = n[alive]
        sub_first = np.cumsum(sub_n) - sub_n
        sub_row = np.repeat(np.arange(len(alive)), sub_n)
        got, value = _em(like[words], sub_row, sub_first, sub_n.astype(float), (rank[alive] < size).astype(float), ROUNDS)
        gain = value - best[alive] > penalty * np.log(sub_n + 1.0)
        better = alive[gain]
        share[better], best[better] = got[gain], value[gain]
        alive = better
    return texts, share


def predict(docs: DataFrame, names: list[str], model: np.ndarray, penalty: float = 2.0) -> DataFrame:
    """doc_id, lang_pred, score (proportion of the predicted language), languages, shares."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letter = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for i, j, data, off in chunks(batch.column(1), 1 << 18):
                m = j - i
                share = np.zeros((m, len(names)))
                place, first, doc = word_trigrams(data, off)
                if len(first) and names:
                    texts, got = infer(place, first, doc, sent.value, penalty)
                    share[texts] = got
                share[~letter[i:j]] = 0.0
                pred, score, sets, shares = [], [], [], []
                for s in share:
                    at = [k for k in np.argsort(-s, kind="stable").tolist() if s[k] > 0]
                    sets.append([names[k] for k in at])
                    shares.append([float(s[k]) for k in at])
                    pred.append(sets[-1][0] if at else "und")
                    score.append(min(1.0, shares[-1][0]) if at else 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, m), pa.array(pred), pa.array(score, pa.float64()),
                     pa.array(sets, pa.list_(pa.string())), pa.array(shares, pa.list_(pa.float64()))],
                    ["doc_id", "lang_pred", "score", "languages", "shares"])

    return (docs.select("doc_id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letter"))
            .mapInArrow(run, "doc_id long, lang_pred string, score double, languages array<string>, shares array<double>"))


def keep_language(docs: DataFrame, least: float = 0.5, languages: list[str] | None = None, penalty: float = 2.0,
                  id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs``, all columns, that have a language (one of ``languages``, if given) in at
    least the share ``least`` of their words; learns from ``docs`` as ``identify``."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                    F.col(lang_col).cast("string").alias("lang"))
    names, model = learn(d.where((id_remainder(F.col("doc_id"), 3) != 1) & F.col("lang").isNotNull()))
    wanted = np.array([languages is None or n in languages for n in names], bool)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in chunks(batch.column(at), 1 << 18):
                good = np.zeros(j - i, bool)
                place, first, doc = word_trigrams(data, off)
                if len(first) and names:
                    texts, share = infer(place, first, doc, sent.value, penalty)
                    best = share.argmax(1)
                    good[texts] = (share[np.arange(len(texts)), best] >= least) & wanted[best]
                yield batch.slice(i, j - i).filter(pa.array(good))
    # a text whose only high bytes are signs has no letter
    return docs.where(F.col(text_col).rlike(r"\p{L}")).mapInArrow(run, docs.schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages, shares; ids with remainder 1 are never learned from."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                    F.col(lang_col).cast("string").alias("lang"))
    remainder = id_remainder(F.col("doc_id"), 3)
    names, model = learn(d.where((remainder != 1) & F.col("lang").isNotNull()))
    out = predict(d.select("doc_id", "text"), names, model)
    return out.select("doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), "lang_pred", "score",
                      "languages", "shares")
