"""Corpus preparation: quality classifier, language ID, near-duplicate removal, packing.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and reread as the next
stage's documents. All but the last return the columns of documents, filtered; the last returns the
pieces of the packed sequences. Unlike texts that share a doc_id are documents each for themselves.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fipsight.llm.langid import keep_language
from fipsight.llm.neardup import one_of_each
from fipsight.llm.packing import pack_documents, piece_digests
from fipsight.llm.quality import keep_good
from fipsight.llm.store import Folder


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.5."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language that holds at least 0.3 of their words; texts without letters go."""
    return keep_language(docs, least=0.3)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the least doc_id, null last) of each class of near-duplicates."""
    return one_of_each(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all kept documents in sequences of 1024 tokens."""
    return piece_digests(pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [("quality_classifier", quality_classifier), ("language_id", language_id), ("near_dedup", near_dedup),
          ("packing", packing)]

#: Trained models, sketches and a tokenizer: not expressible in SQL; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; returns the rows of the last one."""
    folder = Folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = folder.keep(stage(spark, docs, sf_dir), name)
    return docs
