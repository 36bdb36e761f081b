"""Every stage against a plain computation on what the stage before it kept."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from fipsight.llm.langid import identify
from fipsight.llm.neardup import near_duplicates
from fipsight.llm.quality import classify
from test_neardup import brute_classes
from test_packing import check

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder, out = tmp_path_factory.mktemp("pipeline"), []
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in C.STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, SF).write.parquet(path)
        out.append((name, docs, spark.read.parquet(path)))
        docs = out[-1][2]
    return out


def test_stages_in_order_keep_the_columns(spark, stages):
    assert [s[0] for s in stages] == ["quality_classifier", "language_id", "near_dedup", "packing"]
    columns = spark.read.parquet(f"{SF}/documents.parquet").dtypes
    assert all(after.dtypes == columns for _, _, after in stages[:-1])


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_quality_stage(spark, stages):
    _, before, after = stages[0]
    scored = classify(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(after) == ids(scored.where("predicted = 1"))
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1")
    clean = before.join(labels, "doc_id", "left_semi")
    assert clean.join(after, "doc_id", "left_anti").count() <= 0.005 * clean.count()
    assert after.exceptAll(before).count() == 0


def test_language_stage(stages):
    _, before, after = stages[1]
    assert ids(after) == ids(identify(before).where("lang_pred <> 'und' AND score >= 0.3"))
    assert after.count() >= 0.995 * before.count()


def test_near_dedup_stage(stages):
    _, before, after = stages[2]
    rows = sorted(before.select("doc_id", "text").collect())
    classes = brute_classes([r.text for r in rows])
    assert ids(after) == [rows[i].doc_id for i in sorted(set(classes))]


def test_packing_stage(stages):
    _, before, after = stages[3]
    assert check(after.collect(), {r.doc_id: [r.text] for r in before.collect()}) == 0


def test_run_equals_the_stages(spark, stages):
    got = C.run(spark, SF)
    assert sorted(map(tuple, got.select("doc_id", "start", "length", "ids_crc32").collect()))
    assert ids(got.select("doc_id").distinct()) == ids(stages[2][2])


def test_odd_rows(spark, odd_docs):
    docs = odd_docs.drop("hash", "score", "count").withColumn("lang", F.lit("en"))
    for _, stage in C.STAGES:
        assert stage(spark, docs.where("false"), "/root/testdata/sf0.001").count() == 0
    kept = C.near_dedup(spark, docs, SF)
    assert ids(kept) == [0, 1, 2, 3, 4, 5, 6, 7, 9, 10] and kept.columns == docs.columns
    clash = odd_docs.withColumnRenamed("hash", "class_id").withColumnRenamed("count", "goes")
    assert ids(C.near_dedup(spark, clash, SF)) == ids(kept)
    assert set(ids(C.language_id(spark, docs, SF))).isdisjoint({0, 1, 2, 9})
    assert C.quality_classifier(spark, docs, "/root/testdata/sf0.001").columns == docs.columns
    assert near_duplicates(docs).count() == docs.count()
