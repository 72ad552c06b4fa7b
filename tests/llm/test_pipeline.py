"""The corpus pipeline, stage by stage."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_llm import ODD, PERSONAL, documents


@pytest.fixture(scope="module")
def folder(tmp_path_factory, spark):
    path = str(tmp_path_factory.mktemp("tables"))
    base = " ".join(f"good{k}" for k in range(90))
    item = " ".join(f"item{k}" for k in range(12))
    rows = ODD + [
        (10, base, "en", "s", 1), (11, f"{base} end", "en", "s", 1), (11, f"{base} end", "en", "s", 1),
        (12, " ".join(f"c{k}" for k in range(60)) + " " + item, "en", "s", 1),
        (13, " ".join(f"p{k}x" for k in range(60)) + " " + PERSONAL, "en", "s", 1),
        (14, "again and " * 60, "en", "s", 1), (15, " ".join(f"d{k}" for k in range(70)), "en", "s", 1)]
    documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(
        f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = stage(spark, docs, folder)
        assert new.columns == docs.columns and new.dtypes == docs.dtypes
        ids.append(Counter(r.doc_id for r in new.select("doc_id").collect()))
        docs = corpus_pipeline.stored(new, name)
    assert ids[0] == Counter([7, 10, 11, 11, 12, 13, 15])
    assert ids[1] == Counter([7, 10, 12, 13, 15])
    assert ids[2] == ids[3] == Counter([7, 10, 13, 15])
    assert docs.where(F.col("text").contains("4041894974608795")).count() == 0
    assert docs.where("n_chars <> char_length(text)").count() == 0
    packed = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in packed.collect()} == {7, 10, 13, 15}


def test_empty_documents(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").limit(0).write.parquet(
        f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
