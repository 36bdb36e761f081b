import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from fipsight.llm.packing import Packer, pack_documents, piece_digests

JSON = P.path("byte_bpe_50k.json")


def check(rows, texts):
    """Every id in exactly one piece; windows gapless, at most 1024 long; returns the padding."""
    tok = Tokenizer.from_file(JSON)
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for doc, copies in texts.items():
        ids = np.array(tok.encode(copies[0], add_special_tokens=False).ids + [0], "<u4")
        got = sorted(by_doc[doc], key=lambda r: r.start)
        covered = np.zeros(len(ids), int)
        for r in got:
            covered[r.start:r.start + r.length] += 1
            assert r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
        assert (covered == len(copies)).all()
    padding = 0
    for rs in by_seq.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    return padding


def test_documents_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = piece_digests(pack_documents(docs, JSON)).collect()
    texts = {r.doc_id: [r.text or ""] for r in docs.collect()}
    assert check(rows, texts) == 0


def test_odd_rows(spark, odd_docs):
    texts = {}
    for r in odd_docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text or "")
    rows = piece_digests(pack_documents(odd_docs.repartition(3, "doc_id"), JSON)).collect()
    assert check(rows, texts) == 0


def test_empty_table(spark, odd_docs):
    assert pack_documents(odd_docs.where("false"), JSON).count() == 0


def test_level_choice_is_the_least_sum_of_squares():
    rng = np.random.default_rng(3)
    p = Packer(16)
    for i in range(400):
        size = int(rng.integers(1, 16))
        costs = {}
        for h in range(0, 16 - size + 1):
            if h and not p.count[h]:
                continue
            c = p.count[:16].copy()
            if h:
                c[h] -= 1
            if h + size < 16:
                c[h + size] += 1
            costs[h] = int((c * c).sum())
        h = p.best_level(size)
        assert costs[h] == min(costs.values())
        assert h == max(k for k, v in costs.items() if v == costs[h])
        p.add(i, np.arange(size, dtype=np.int32))
        assert [len(x) for x in p.open] == p.count[:16].tolist()


@pytest.mark.parametrize("sizes", [[5], [16], [17, 31, 1], [3, 3, 3], []])
def test_finish_leaves_no_padding(sizes):
    p = Packer(16)
    for i, n in enumerate(sizes):
        p.add(i, np.arange(n, dtype=np.int32))
    p.finish()
    assert sum(len(r[2]) for r in p.done) == sum(sizes)
    fill = {}
    for r in p.done:
        fill[r[4]] = fill.get(r[4], 0) + len(r[2])
    assert all(f == 16 or f & (f - 1) == 0 for f in fill.values())
