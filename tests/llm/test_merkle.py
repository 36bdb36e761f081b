"""The manifest against a plain Merkle tree built in Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from fipsight.llm import merkle
from fipsight.llm.merkle import climb, leaf_rows, manifest, numbered, verify_documents
from fipsight.llm.store import Folder

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc, text):
    fields = [doc["doc_id"], doc["source"], doc["lang"], doc["n_chars"], text]
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields])


def tree(nodes):
    """(root, for each node its siblings (left, right) on every level)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        runs = [level[i:i + 3] for i in range(0, len(level), 3)]
        for k, place in enumerate(at):
            run, slot = runs[place // 3], place % 3
            paths[k].append(("".join(run[:slot]), "".join(run[slot + 1:])))
            at[k] = place // 3
        level = [h(*run) for run in runs]
    return level[0], paths


def brute(docs):
    by = {}
    for d in docs:
        by.setdefault(d["source"], []).append((-1 if d["doc_id"] is None else 0, d["doc_id"] or 0, leaf(d, d["text"]), d))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in sources}
    root, above = tree([trees[s][0] for s in sources])
    out = []
    for s, up in zip(sources, above):
        for (*_, own, d), path in zip(sorted(by[s], key=lambda x: x[:3]), trees[s][1]):
            path = path + up
            even = d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 2 == 0
            at = leaf(d, d["text"].replace("\n", "")) if even and d["text"] is not None else own
            for left, right in path:
                at = h(left, at, right)
            out.append((d["doc_id"], own, trees[s][0], root, h(*[a + b for a, b in path]), at, at == root))
    return out


def key(rows):
    return sorted(map(tuple, rows), key=repr)


def docs_of(sizes):
    return [{"doc_id": i * 7 % 1009 + 2000 * n, "source": s, "lang": [None, "", "en"][i % 3], "n_chars": [None, i][i % 2],
             "text": [None, "", "a\nb", "é\n\n日本", "plain"][i % 5]} for n, (s, size) in enumerate(sizes.items()) for i in range(size)]


def frame(spark, docs):
    df = spark.createDataFrame([tuple(d.values()) for d in docs], SCHEMA)
    return df.withColumns({"leaf": F.lit(1), "place": F.lit("x"), "tree": F.lit(None).cast("int"), "digest": F.lit("d")})


def test_small_trees_of_every_shape(spark):
    docs = docs_of({None: 1, "": 2, "a": 3, "B": 4, "é": 9, "z": 10, "日本": 28, "𝒳": 82})
    assert key(verify_documents(frame(spark, docs)).collect()) == key(brute(docs))


@pytest.mark.parametrize("size", [8, 9, 10, 81, 82, 250])
def test_several_rounds(spark, size, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 2)  # blocks of nine nodes
    docs = docs_of({"hot": size, "b": 1, **{f"s{i}": 1 for i in range(20)}})
    assert key(verify_documents(frame(spark, docs)).collect()) == key(brute(docs))


def test_repeated_rows_null_ids_and_a_very_long_text(spark):
    docs = docs_of({"a": 5, None: 3})
    docs += [docs[1], docs[1], {**docs[1], "text": "other\n"}, {**docs[0], "doc_id": None}, {**docs[2], "doc_id": None},
             {**docs[0], "doc_id": 99, "text": "word\n" * 400_000}, {**docs[0], "doc_id": -3}]
    assert key(verify_documents(frame(spark, docs)).collect()) == key(brute(docs))


def test_one_document_and_none(spark):
    docs = docs_of({"a": 1})
    row = verify_documents(frame(spark, docs)).first()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == h()
    assert verify_documents(frame(spark, docs).where("false")).count() == 0


def test_real_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = verify_documents(docs)
    rows = got.collect()
    assert key(rows) == key(brute([r.asDict() for r in docs.collect()]))
    assert 0 < sum(r.verified for r in rows) < len(rows)


def test_any_changed_field_changes_the_root(spark):
    docs = docs_of({"a": 30, "b": 12})
    root = manifest(leaf_rows(frame(spark, docs))).first().root
    for change in ({"lang": "xx"}, {"n_chars": 5555}, {"text": "T"}, {"source": "c"}, {"doc_id": 77_777}):
        assert manifest(leaf_rows(frame(spark, [{**docs[4], **change}, *docs[:4], *docs[5:]]))).first().root != root


def test_numbers_inside_hot_trees(spark):
    folder = Folder(spark, "test")
    rows = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE string(id % 7) END AS tree", "-id AS v")
    got = numbered(folder.keep(rows, "rows"), ["v"], folder, "t").toPandas()
    for _, g in got.groupby("tree"):
        g = g.sort_values("v")
        assert list(g.place) == list(range(len(g))) and (g["size"] == len(g)).all()
    nodes = spark.createDataFrame([("t", i, 5, h(str(i))) for i in range(5)], "tree string, place long, size long, digest string")
    assert {r.top for r in climb(nodes, folder).collect()} == {tree([h(str(i)) for i in range(5)])[0]}
