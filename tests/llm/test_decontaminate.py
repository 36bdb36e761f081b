"""Decontamination against a plain search for every window in every document."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fipsight.llm.decontaminate import contamination_digests, decontaminate, gram_size, winnow

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, span=10):
    windows = {}
    for item, text in items:
        w = words(text)
        t = min(len(w), span)
        for p in range(len(w) - t + 1 if w else 0):
            windows.setdefault(tuple(w[p:p + t]), set()).add(item)
    sizes = {len(x) for x in windows}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, named = set(), set()
        for t in sizes:
            for p in range(len(w) - t + 1):
                found = windows.get(tuple(w[p:p + t]))
                if found:
                    hit |= set(range(p, p + t))
                    named |= {str(x) for x in found if x is not None}
        out.append((doc, len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def found(docs, items, **more):
    return sorted((tuple(r) for r in contamination_digests(decontaminate(docs, items, **more)).collect()), key=repr)


def frames(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"key": F.lit("clash"), "items": F.lit(1), "n_words": F.lit("x")})
    b = spark.createDataFrame(items, "item_id long, text string").withColumns({"hash": F.lit(1), "span": F.lit("clash")})
    return d, b


def mixed(seed, n_docs=120):
    """Texts over few words, so that windows meet often; items of 0 to 30 words, copies and common passages."""
    r = random.Random(seed)
    pool = [f"w{i}" for i in range(12)] + ["É", "日本", "X9"]
    say = lambda n: r.choice([" ", ", ", "\n"]).join(r.choice(pool) for _ in range(n))
    items = [(i, say(r.choice([1, 4, 5, 9, 10, 11, 12, 30]))) for i in range(25)] + [(3, say(14)), (None, say(12)), (50, None), (51, "--")]
    items += [(60, items[20][1]), (61, items[20][1].upper())]
    docs = []
    for i in range(n_docs):
        parts = [say(r.randrange(0, 25)) for _ in range(3)]
        parts.insert(1, r.choice(items)[1] or "")
        parts.insert(3, " ".join(words(r.choice(items)[1])[-r.choice([9, 10, 11]):]))
        docs.append((i, " ".join(parts)))
    return docs, items


@pytest.mark.parametrize("seed,span", [(1, 10), (2, 10), (3, 7), (4, 2), (5, 1)])
def test_mixed_texts(spark, seed, span):
    docs, items = mixed(seed)
    assert found(*frames(spark, docs, items), span=span) == brute(docs, items, span)


def test_without_the_broadcast_hashes(spark):
    docs, items = mixed(6)
    assert found(*frames(spark, docs, items), most_hashes=0) == brute(docs, items)


def test_odd_rows(spark, odd_docs):
    ten = " ".join(f"t{i}" for i in range(10))
    docs = [(0, None), (1, ""), (2, "?!"), (3, ten), (4, ten.upper() + "!"), (5, ten[:-1]), (None, ten), (None, "a " + ten), (3, ten),
            (3, "other"), (7, "one"), (8, ten + " " + ten), (9, ("x " * 200_000) + ten + " y" * 200_000)]
    items = [(1, ten), (2, ten), (10, "t1 t2"), (None, "one"), (4, None), (5, " ")]
    assert found(*frames(spark, docs, items)) == brute(docs, items)
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    items = [(1, rows[5][1][:400]), (2, "same same"), (3, "テキスト é")]
    assert found(odd_docs, frames(spark, docs, items)[1]) == brute(rows, items)


def test_a_passage_in_a_third_of_all_documents(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    docs = [(i, f"a{i} " + passage + f" z{i}" if i % 3 == 0 else f"b{i} " * 30) for i in range(900)] + [(1000 + i, passage) for i in range(300)]
    items = [(i, f"q{i} " + passage) for i in range(30)]
    assert found(*frames(spark, docs, items)) == brute(docs, items)


def test_real_rows(spark, sf):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    got = found(docs, items)
    assert got == brute([tuple(r) for r in docs.select("doc_id", "text").collect()],
                        [tuple(r) for r in items.select("item_id", "text").collect()])
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a b c")], [(1, "a b c")])
    assert found(docs.where("false"), items) == []
    assert found(docs, items.where("false")) == brute([(1, "a b c")], [])


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 12), st.lists(st.integers(0, 3), max_size=60), st.data())
def test_every_window_keeps_a_hash_that_depends_on_it_alone(span, said, data):
    lengths = data.draw(st.lists(st.integers(0, 25), min_size=1, max_size=4))
    text = np.array(said, np.uint64)
    doc = np.sort(np.arange(len(text)) % len(lengths))
    place, _ = winnow(text, doc, span)
    w = span - gram_size(span) + 1
    for p in range(len(text) - span + 1):
        if doc[p] == doc[p + span - 1]:
            alone, _ = winnow(text[p:p + span], np.zeros(span, np.int64), span)
            assert len(alone) == 1 and p + alone[0] in place
    assert all(any(doc[max(q, 0)] == doc[min(q + span - 1, len(text) - 1)] for q in range(p - w + 1, p + 1)) for p in place)
