from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from fipsight.llm.graph import components
from fipsight.llm.neardup import bags, near_duplicates, one_of_each, signatures, similarity
from fipsight.llm.store import Folder
from fipsight.llm.text import chunks, word_hashes


def bag_of(text):
    w = [x.lower() if x.isascii() else "".join(c.lower() if c.isascii() else c for c in x)
         for x in (text or "").translate({c: 32 for c in range(9, 14)}).split(" ") if x]
    if not w:
        return Counter()
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)])


def brute_classes(texts):
    """Class of each text by comparing all pairs that share a shingle."""
    bag = [bag_of(t) for t in texts]
    where = {}
    for i, b in enumerate(bag):
        for s in b:
            where.setdefault(s, []).append(i)
    above = list(range(len(texts)))

    def root(x):
        while above[x] != x:
            x = above[x]
        return x
    seen = set()
    for ids in where.values():
        for a in range(len(ids)):
            for b in range(a):
                seen.add((ids[b], ids[a]))
    for a, b in seen:
        low = sum(min(bag[a][s], bag[b][s]) for s in bag[a])
        if low >= 0.8 * (sum(bag[a].values()) + sum(bag[b].values()) - low):
            x, y = root(a), root(b)
            above[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(texts))]


def partition(ids, classes):
    out = {}
    for i, c in zip(ids, classes):
        out.setdefault(c, set()).add(i)
    return sorted(map(sorted, out.values()))


def test_documents_table_equals_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = {r.doc_id: r for r in near_duplicates(docs).collect()}
    assert len(got) == len(rows)
    want = partition([r.doc_id for r in rows], brute_classes([r.text for r in rows]))
    assert partition(got, [r.class_id for r in got.values()]) == want
    assert all(r.class_id == min(g) and r.class_size == len(g) for g in want for r in [got[i] for i in g])


def test_crowd_of_half_alike_texts(spark):
    """Many texts share most words and lie around the threshold: no link may be lost."""
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(700):
        w = list(base)
        for k in rng.integers(0, 60, int(rng.integers(0, 6))):
            w[k] = f"x{rng.integers(0, 4)}_{k}"
        texts.append(" ".join(w))
    texts += [" ".join(base[:40] + [f"own{i}_{k}" for k in range(20)]) for i in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = near_duplicates(df).collect()
    assert partition([r.doc_id for r in got], [r.class_id for r in got]) == \
        partition(range(len(texts)), brute_classes(texts))


def test_signature_estimates_weighted_jaccard():
    rng = np.random.default_rng(0)
    err = []
    for _ in range(60):
        keys = np.unique(rng.integers(0, 2 ** 63, 30).astype(np.uint64))
        a, b = rng.integers(1, 12, len(keys)), rng.integers(1, 12, len(keys))
        s = signatures(np.repeat([0, 1], len(keys)), np.append(keys, keys), np.append(a, b), 2, 512)
        err.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(err)) < 0.01 and np.std(err) < 0.04


def test_bags_and_similarity():
    texts = ["A b c d e a b C d e a b c d e", "a b", "", "a b c d e"]
    (_, _, data, off), = chunks(pa.array(texts))
    text, key, times = bags(*word_hashes(data, off), 4)
    got = {}
    for t, k, n in zip(text.tolist(), key.tolist(), times.tolist()):
        got.setdefault(t, []).append((k, n))
    assert sorted(n for _, n in got[0]) == sorted(bag_of(texts[0]).values())
    assert len(got[1]) == 1 and 2 not in got and got[3][0][0] in dict(got[0])
    b = [(np.array([k for k, _ in got[t]], np.uint64), np.array([n for _, n in got[t]]), sum(n for _, n in got[t]))
         for t in (0, 3)]
    assert similarity(*b) == pytest.approx(1 / 11)


def test_odd_rows(spark, odd_docs):
    rows = near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert partition([r.doc_id for r in rows], [r.class_id for r in rows]) == [
        [0], [1], [2], [3], [4], [5], [6], [7, 8], [9], [10]]
    assert {r.class_size for r in rows if r.doc_id == 7} == {3}
    assert near_duplicates(odd_docs.where("false")).count() == 0
    nulls = spark.createDataFrame([(None, "a b c"), (4, "A b  c"), (None, None)], "doc_id long, text string")
    assert sorted((str(r.doc_id), str(r.class_id)) for r in near_duplicates(nulls).collect()) == [
        ("4", "4"), ("None", "4"), ("None", "None")]


def texts_in_pairs(n):
    """n texts in near-copy pairs."""
    return [" ".join(f"p{i // 2}w{k}" for k in range(40 - i % 2)) for i in range(n)]


def test_many_rows_without_an_id_or_with_one_id(spark):
    texts = texts_in_pairs(300)
    rows = [(None, t) for t in texts[:200]] + [(5, t) for t in texts[200:]]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert len(got) == 300 and all(r.class_size == 2 for r in got)
    mixed = [(None, t) for t in texts] + [(i, t) for i, t in enumerate(texts) if i % 3]
    got = near_duplicates(spark.createDataFrame(mixed, "doc_id long, text string")).collect()
    assert sorted(r.class_size for r in got if r.doc_id is not None) == sorted(
        2 + sum(j % 3 > 0 for j in (i - i % 2, i - i % 2 + 1)) for i in range(300) if i % 3)


def test_rows_are_kept_by_id_and_text(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(1, a, "first"), (1, b, "unlike"), (2, a + " more", "near copy"), (None, b, "copy without id"), (None, c, "alone"),
            (None, c.upper(), "copy of alone"), (7, None, "no words"), (7, "", "no words"), (1, a, "repeated"), (9, c + " x", "named")]
    df = spark.createDataFrame(rows, "doc_id long, text string, note string")
    got = sorted((str(r.doc_id), (r.text or "")[:2], r.note) for r in one_of_each(df).collect())
    assert [(i, t) for i, t, _ in got] == [("1", "a0"), ("1", "b0"), ("7", ""), ("9", "c0")]
    unnamed = df.where("doc_id IS NULL")
    assert sorted(r.text[:2].lower() for r in one_of_each(unnamed).collect()) == ["b0", "c0"]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(300, 300), (7, 6)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "u long, v long"), Folder(spark, "t")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}}
