import hashlib

import public_tokenizers as P
import pytest
import tiktoken

from fipsight.llm.bpe import decode_documents, encode_documents, encoding_digests, load_ranks

RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(RANKS), special_tokens={})


def want(rows, library):
    out = []
    for r in rows:
        ids = library.encode_ordinary(r.text or "")
        out.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256((r.text or "").encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("block", [1, 20_000, 16 << 20])
def test_digests_equal_the_library(spark, sf, odd_docs, library, block):
    for docs in (spark.read.parquet(f"{sf}/documents.parquet"), odd_docs):
        got = encoding_digests(encode_documents(docs, RANKS, P.PATTERN, block_bytes=block), RANKS)
        assert sorted(map(tuple, got.collect())) == want(docs.collect(), library)


def test_decoded_bytes(spark, odd_docs):
    rows = decode_documents(encode_documents(odd_docs, RANKS, P.PATTERN), RANKS).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in odd_docs.collect()}
    assert len(rows) == odd_docs.count()
    assert all(bytes(r.decoded) == texts[r.doc_id] for r in rows)


def test_empty_table(spark, odd_docs):
    assert encoding_digests(encode_documents(odd_docs.where("false"), RANKS, P.PATTERN), RANKS).count() == 0
