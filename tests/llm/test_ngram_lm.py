import math
import zlib
from collections import Counter

import numpy as np
import pytest

from fipsight.llm.eliasfano import EliasFano, encode
from fipsight.llm import ngram_lm
from fipsight.llm.ngram_lm import MU, Frequent, _gram_order, pack_grams, score_documents, unpack_grams
from fipsight.llm.ngram_trie import NgramTrie, quantise, restore


def tokens_of(text):
    t = (text or "").translate({c: 32 for c in range(9, 14)})
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in t.split(" ") if w] + [None]


def brute(rows):
    learn = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 != 2]
    uni, bi = Counter(), Counter()
    for _, text in learn:
        t = tokens_of(text)
        uni.update(t)
        bi.update(zip(["<s>", *t[:-1]], t))
    n, v = sum(uni.values()), len(uni)
    out = []
    for i, text in rows:
        t = tokens_of(text)
        p1 = [(uni[w] + 1) / (n + v + 1) for w in t]
        ctx = [len(learn), *[uni[w] for w in t[:-1]]]
        p2 = [(bi[p, w] + MU * q) / (c + MU) for p, w, q, c in zip(["<s>", *t[:-1]], t, p1, ctx)]
        out.append((i, len(t), sum(uni[w] > 0 for w in t), n, sum(map(math.log10, p1)), sum(map(math.log10, p2))))
    return out


@pytest.mark.parametrize("block", [1, 100_000, 12 << 20])
def test_scores_equal_a_plain_count(spark, sf, odd_docs, block):
    for docs in (spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), odd_docs.repartition(2, "doc_id")):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        got = score_documents(docs, block_bytes=block).collect()
        assert len(got) == len(rows)
        for g, w in zip(sorted(got), sorted(brute(rows), key=lambda x: x[0])):
            assert (g.doc_id, g.n_tokens, g.n_known, g.train_tokens) == w[:4]
            assert g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 7 == 2)
            assert g.base_score == pytest.approx(w[4], rel=1e-12) and g.score == pytest.approx(w[5], rel=1e-9)


@pytest.mark.parametrize("block", [1, 12 << 20])
def test_order_three_equals_a_plain_count(spark, sf, odd_docs, block):
    for docs in (spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), odd_docs.repartition(2, "doc_id")):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        uni, bi, tri = Counter(), Counter(), Counter()
        learn = [tokens_of(t) for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
        for t in learn:
            uni.update(t)
            bi.update(zip(["<s>", *t[:-1]], t))
            tri.update(zip(["<s>", *t[:-2]], t[:-1], t[1:]))
        n, v, want = sum(uni.values()), len(uni), []
        for i, text in rows:
            t, total = tokens_of(text), 0.0
            for k, w in enumerate(t):
                u = t[k - 1] if k else "<s>"
                p = (bi[u, w] + MU * (uni[w] + 1) / (n + v + 1)) / ((uni[u] if k else len(learn)) + MU)
                if k:
                    before = t[k - 2] if k > 1 else "<s>"
                    p = (tri[before, u, w] + MU * p) / (bi[before, u] + MU)
                total += math.log10(p)
            want.append((i, total))
        got = sorted((r.doc_id, r.score) for r in score_documents(docs, block_bytes=block, order=3).collect())
        assert [g[0] for g in got] == [i for i, _ in sorted(want)]
        assert [g[1] for g in got] == pytest.approx([x for _, x in sorted(want)], rel=1e-9)


def test_held_out_texts_are_likelier_than_by_words_alone(spark):
    m = score_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).toPandas()
    h = m[m.held_out]
    assert h.score.sum() > h.base_score.sum()


def test_empty_table_and_nothing_to_learn(spark, odd_docs):
    assert score_documents(odd_docs.where("false")).count() == 0
    only = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    r = score_documents(only).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)


@pytest.mark.parametrize("n,top", [(0, 0), (1, 0), (1, 10 ** 15), (1000, 50), (5000, 10 ** 12)])
def test_elias_fano_round_trip(n, top):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, top + 1, n))
    e = EliasFano(encode(v))
    at = rng.permutation(n)
    assert (e[at] == v[at]).all() and (e.decode(0, n) == v).all()
    assert (e.decode(n // 3, n // 2) == v[n // 3:n // 2]).all()


@pytest.mark.parametrize("order", [1, 2, 3])
def test_trie_equals_a_dictionary(order):
    rng = np.random.default_rng(order)
    words = np.sort(rng.integers(0, 2 ** 63, 300).astype(np.uint64))
    grams = np.unique(rng.integers(0, 300, (4000, order)), axis=0)
    code = rng.integers(1, 60000, len(grams)).astype(np.uint16)
    trie = NgramTrie([words[grams[:, k]] for k in range(order)], code)
    known = {tuple(g): c for g, c in zip(grams.tolist(), code.tolist())}
    ask = rng.integers(0, 301, (8000, order))
    got = trie.find([np.append(words, np.array([5], np.uint64))[ask[:, k]] for k in range(order)], 1000)
    assert got.tolist() == [known.get(tuple(a), 0) for a in ask.tolist()]
    assert NgramTrie([np.zeros(0, np.uint64)] * order, code[:0]).find([words] * order).sum() == 0


@pytest.mark.parametrize("order", [1, 2, 3])
def test_grams_round_trip(order):
    rng = np.random.default_rng(order)
    for top, n in ((4, 50), (70000, 5000), (2 ** 40, 300), (1, 1)):
        grams = np.unique(rng.integers(0, top, (n, order)), axis=0)
        got = unpack_grams(pack_grams(list(grams.T)), order)
        assert (np.stack(got, axis=1) == grams).all()
    assert [len(g) for g in unpack_grams(pack_grams([np.zeros(0, np.int64)] * order), order)] == [0] * order


def test_gram_order_beyond_one_key():
    grams = list(np.random.default_rng(0).integers(0, 9, (3, 400)))
    assert (_gram_order(grams, 9) == _gram_order(grams, 1 << 30)).all()


def test_numbers_of_frequent_words():
    words = np.array([3, 8, 9], np.uint64)
    f = Frequent(words, np.array([2, 0, 1]))
    assert f.numbers(np.array([9, 1, 8, 10, 3], np.uint64)).tolist() == [1, 3, 0, 3, 2]


@pytest.mark.parametrize("frequent", [0, 50])
def test_few_or_no_frequent_words_and_many_shards(spark, sf, frequent, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    want = {r.doc_id: r.score for r in score_documents(docs, order=3).collect()}
    monkeypatch.setattr(ngram_lm, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", 5000)
    got = {r.doc_id: r.score for r in score_documents(docs, block_bytes=60_000, order=3).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)


def test_cleanup_setting_is_restored(spark, odd_docs):
    from fipsight.llm.store import CLEANUP
    before = spark.conf.get(CLEANUP)
    score_documents(odd_docs)
    assert spark.conf.get(CLEANUP) == before


def test_quantised_counts():
    c = np.concatenate([np.arange(40000), 10 ** np.arange(5, 13)])
    r = restore(quantise(c))
    assert (r[:32768] == c[:32768]).all() and (r <= c).all() and (r >= 0.998 * c).all()
