"""The audit against plain filtering of every document in every order."""

import itertools
import math
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fipsight.llm.audit import MOST_FILTERS, Diagram, adjacent_swaps, audit, audit_documents, audit_rows

LABELS = "doc_id long, quality int, toxic int"


def failures(doc, docs):
    """Letters of the filters that one row fails, from the definitions."""
    text = doc["text"] or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = ""
    if len(words) < 200:
        out += "A"
    if 100 * len(set(words)) < 50 * len(words):
        out += "B"
    if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text):
        out += "C"
    if re.search(r"[#$%&*|]", text):
        out += "D"
    if doc["doc_id"] is not None and any(o["doc_id"] is not None and o["doc_id"] < doc["doc_id"]
                                         and (o["text"] or "") == text for o in docs):
        out += "E"
    return out


def brute(docs, labels):
    good, toxic = ({r[0] for r in labels if r[0] is not None and r[k] == 1} for k in (1, 2))
    rows = {}
    for part in {d["lang"] or "" for d in docs}:
        own = [(d, failures(d, docs)) for d in docs if (d["lang"] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d, x in left if f in x]
                left = [(d, x) for d, x in left if f not in x]
                shapley[f] += len(gone)
                rows[part, order, step] = [
                    len(left), len(gone), sum(f in x for _, x in own) - len(gone), sum(x == f for _, x in own),
                    sum(d["doc_id"] in good for d in gone), sum(d["doc_id"] in toxic for d in gone)]
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                rows[part, order, step].append(shapley[f])
    return rows


def found(df):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost,
                                               r.shapley] for r in df.collect()}


@pytest.mark.parametrize("k", [1, 2, 3, 5, 6])
def test_swaps_run_through_all_orders(k):
    order = list(range(k))
    seen = {tuple(order)}
    for i in adjacent_swaps(k):
        order[i], order[i + 1] = order[i + 1], order[i]
        seen.add(tuple(order))
    assert len(seen) == math.factorial(k) == 1 + sum(1 for _ in adjacent_swaps(k))


def test_equal_counts_share_nodes():
    # four variables, counts depend on the first alone: one node on each level below it and side
    diagram = Diagram({m: (1 + m % 2,) for m in range(16)}, 4, 1)
    assert [len(x) for x in diagram.levels] == [1, 2, 2, 2] and len(diagram.leaves) == 2
    for i in (0, 1, 2):  # the variable that matters sinks to the last level
        diagram.swap(i)
    assert [len(x) for x in diagram.levels] == [1, 1, 1, 1] and diagram.root[2] == (24,)


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(0, 15), st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(0, 3))))
def test_any_counts(counts):
    rows = audit_rows(counts, list("abcd"))
    assert len(rows) == 24 * 4
    for r in rows:
        before, own = ["abcd".index(x) for x in r["filter_order"][:r["step"] - 1]], "abcd".index(r["filter_order"][r["step"] - 1])
        here = [c for m, c in counts.items() if m >> own & 1 and not any(m >> b & 1 for b in before)]
        assert r["removed"] == sum(c[0] for c in here) and r["good_lost"] == sum(c[1] for c in here)
        assert r["kept"] == sum(c[0] for m, c in counts.items() if not any(m >> b & 1 for b in [*before, own]))
        assert r["redundant"] == sum(c[0] for m, c in counts.items() if m >> own & 1) - r["removed"]
        assert r["unique_fails"] == counts.get(1 << own, (0,))[0]


def test_odd_rows(spark):
    many = " ".join(f"w{i}" for i in range(250))
    texts = [many, many, many + " $", None, "", "  ", "A B C", many, "x " * 300, many + " " + "Q" * 60, "日本 é"]
    docs = [{"doc_id": i, "text": t, "lang": [None, "", "en"][i % 3]} for i, t in enumerate(texts)]
    docs += [{"doc_id": 1, "text": many, "lang": "en"}, {"doc_id": 0, "text": many, "lang": "fr"},
             {"doc_id": None, "text": many, "lang": "fr"}, {"doc_id": None, "text": many, "lang": "fr"},
             {"doc_id": 2, "text": "another", "lang": "en"}, {"doc_id": -5, "text": "A B C", "lang": "en"}]
    labels = [(0, 1, 0), (1, 1, 1), (1, 0, 0), (6, None, 1), (None, 1, 1), (99, 1, 1), (2, 0, None)]
    df = spark.createDataFrame([(d["doc_id"], d["text"], d["lang"], 1, "x") for d in docs],
                               "doc_id long, text string, lang string, n long, part string")
    got = found(audit_documents(df, spark.createDataFrame(labels, LABELS)))
    assert got == brute(docs, labels)


def test_real_rows(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = found(audit_documents(docs, labels))
    assert got == brute([r.asDict() for r in docs.collect()], [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])


def test_a_very_long_text_and_a_hot_copy(spark):
    long = "tok " * 400_000
    df = spark.range(600).selectExpr("id AS doc_id", f"CASE WHEN id = 7 THEN repeat('tok ', {len(long) // 4}) "
                                     "WHEN id % 3 = 0 THEN 'same text' ELSE concat('t', id) END AS text", "'en' AS lang")
    got = found(audit_documents(df, spark.createDataFrame([], LABELS)))
    assert got["en", "EABCD", 1][:2] == [401, 199] and got["en", "BACDE", 1][:2] == [599, 1]


def test_empty_table_and_limits(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert audit_documents(docs, spark.createDataFrame([], LABELS)).count() == 0
    with pytest.raises(ValueError):
        audit(docs, [str(i) for i in range(MOST_FILTERS + 1)])
