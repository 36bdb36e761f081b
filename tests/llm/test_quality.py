import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fipsight.llm.linear import ftrl_train, pack_row, sigmoid, unpack_row
from fipsight.llm.quality import DIMS, classify, score, token_features
from fipsight.llm.samples import sampled_labels
from fipsight.llm.text import chunks


@pytest.fixture(scope="module")
def scored(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    return classify(docs, labels).toPandas(), labels.toPandas(), docs.count()


def test_held_out_accuracy(scored):
    got, labels, n = scored
    assert len(got) == n and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.5)).all()
    m = got.merge(labels, on="doc_id")
    m = m[m.held_out]
    assert (m.predicted == m.quality).mean() > 0.97
    assert m[m.quality == 1].predicted.mean() > 0.99


def test_score_is_the_dot_product(spark):
    rng = np.random.default_rng(1)
    w = rng.normal(size=DIMS)
    texts = ["a b a b", "", None, "X!! Y!! same same same", "é ñ 12"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in score(df, w).collect()}
    for k, t in enumerate(texts):
        (_, _, data, off), = chunks(pa.array([t or ""])) if t else [(0, 1, np.zeros(0, np.uint8), np.zeros(2, np.int64))]
        key, _ = token_features(data, off)
        z = w[DIMS - 1] + sum(w[int(x % np.uint64(DIMS - 1))] for x in key) * 16.0 / max(1, len(key))
        assert got[k] == pytest.approx(float(sigmoid(z)))


def test_ftrl_follows_the_published_update():
    index = [np.array([0, 2]), np.array([1, 2])] * 5
    value = [np.array([1.0, 0.5])] * 10
    y = np.array([1.0, 0.0] * 5)
    got = ftrl_train(index, value, y, 4, alpha=0.5, l1=0.1, l2=0.2, epochs=1, seed=0)
    z, n, w = [0.0] * 4, [0.0] * 4, [0.0] * 4

    def weight(i):
        if abs(z[i]) <= 0.1:
            return 0.0
        return -(z[i] - (0.1 if z[i] > 0 else -0.1)) / ((1.0 + n[i] ** 0.5) / 0.5 + 0.2)
    for i in np.random.default_rng(0).permutation(10):
        w = {int(k): weight(k) for k in index[i]}
        p = 1 / (1 + np.exp(-sum(w[int(k)] * v for k, v in zip(index[i], value[i]))))
        for k, v in zip(index[i], value[i]):
            g = (p - y[i]) * v
            s = ((n[k] + g * g) ** 0.5 - n[k] ** 0.5) / 0.5
            z[k] += g - s * w[int(k)]
            n[k] += g * g
    assert got == pytest.approx([weight(k) for k in range(4)])


def test_odd_rows_and_no_labels(spark, odd_docs):
    labels = spark.createDataFrame([(0, 1, "x"), (3, None, "x"), (None, 1, "x"), (7, 0, "x"), (7, 1, "x")],
                                   "doc_id long, quality int, text string")
    got = classify(odd_docs, labels)
    assert got.count() == odd_docs.count() and got.where("score is null").count() == 0
    none = classify(odd_docs, labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}
    assert classify(odd_docs.where("false"), labels).count() == 0


def test_sample_is_bounded_and_repeatable(spark):
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    a = sampled_labels(labels, {"label": F.col("quality")}, F.lit(True), 500)
    got = sorted(r.doc_id for r in a.collect())
    assert 350 < len(got) < 650 and got == sorted(r.doc_id for r in a.collect())


def test_rows_pack_both_ways():
    i, v = unpack_row(pack_row(np.array([3, 9]), np.array([0.5, 2.0])))
    assert i.tolist() == [3, 9] and v.tolist() == [0.5, 2.0]
