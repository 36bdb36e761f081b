import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fipsight.llm.text import chunks
from fipsight.llm.toxicity import FOLDS, Model, add_out_of_fold, chain_key, classify_toxicity, fit_models, sample_rows, word_features


@pytest.fixture(scope="module")
def chain(spark):
    return {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}


@pytest.fixture(scope="module")
def tables(spark):
    d = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")


def test_held_out_accuracy(tables, chain):
    docs, labels = tables
    m = classify_toxicity(docs, labels, chain).toPandas()
    assert len(m) == docs.count()
    m = m.merge(labels.toPandas().rename(columns={"toxic": "y"}), on="doc_id")
    h = m[m.held_out]
    assert h[h.y == 1].toxic.mean() > 0.75 and h[h.y == 0].toxic.mean() < 0.01
    assert (h.low_quality == 1 - h.quality).mean() > 0.95


def test_rare_toxic_words_are_learned(tables, chain):
    docs, labels = tables
    m = classify_toxicity(docs, labels, chain).toPandas().merge(labels.toPandas().rename(columns={"toxic": "y"}), on="doc_id")
    h = m[m.held_out]
    assert h[h.y == 1].toxic.mean() > 0.80 and h[h.y == 0].toxic.mean() < 0.01


def test_probabilities_are_out_of_fold(spark, tables):
    docs, labels = tables
    learn = labels.where("doc_id < 900").select("doc_id", (1 - F.col("quality")).alias("a"), F.col("toxic").alias("b"))
    rows = sample_rows(docs, learn, ["a", "b"])
    models = fit_models(rows, 0)
    assert sorted(models) == list(range(FOLDS + 1))
    for r in add_out_of_fold(rows, models).limit(20).collect():
        k = np.frombuffer(r.keys, np.uint64)
        assert r.earlier == [pytest.approx(models[r.fold].predict(k, np.zeros(len(k), int), [], 1)[0])]
    second = fit_models(add_out_of_fold(rows, models), 1)[FOLDS]
    assert set(second.keys) <= set(np.concatenate([np.frombuffer(r.keys, np.uint64) for r in rows.collect()])) | set(
        chain_key(0))


def test_chain_feeds_earlier_probabilities():
    m = Model(np.sort(chain_key(0)), np.array([2.0]), -1.0)
    p = m.predict(np.zeros(0, np.uint64), np.zeros(0, int), [np.array([0.5, 1.0])], 2)
    assert p == pytest.approx([0.5, 1 / (1 + np.exp(-1.0))])


def test_features_are_distinct_and_local():
    (_, _, data, off), = chunks(pa.array(["Foo foo FOO", "", "foo!!"]))
    key, doc = word_features(data, off)
    assert len(set(zip(doc.tolist(), key.tolist()))) == len(key) and 1 not in doc
    assert len(set(key[doc == 0]) & set(key[doc == 2])) == 1  # the word itself


def test_odd_rows(spark, odd_docs, chain):
    labels = spark.createDataFrame([(0, 1, 0, "x"), (3, None, 1, "x"), (None, 1, 1, "x"), (7, 0, 1, "x"), (7, 1, 1, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    got = classify_toxicity(odd_docs, labels, chain)
    assert got.count() == odd_docs.count() and got.where("toxic_score is null").count() == 0
    none = classify_toxicity(odd_docs, labels.where("false"), chain).collect()
    assert {(r.low_quality_score, r.toxic_score) for r in none} == {(0.5, 0.5)}
    assert classify_toxicity(odd_docs.where("false"), labels, chain).count() == 0
