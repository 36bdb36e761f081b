"""Small awkward tables shared by the operator tests."""

import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, blank, very long, repeated, non-Latin texts; clashing extra columns."""
    long = " ".join(f"word{i % 997} and{i % 31}." for i in range(30000))
    texts = [None, "", "   \n\t ", "one", "don't we'll 'tis 1²x  y\n\n z <|endoftext|> end", long, "日本語 テキスト é ß",
             "same same same", "same same same", "!!! $$$ ???", "x" * 5000]
    rows = [(i, t, "en" if i % 2 else None, "s", None) for i, t in enumerate(texts)]
    rows.append((7, "same same same", "en", None, 3))  # a repeated id
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumn("hash", F.lit("clash")).withColumn("score", F.lit(1)).withColumn("count", F.lit(2))


def one_file(df, folder, name):
    """Write a frame as the single-file table that the queries read."""
    df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
