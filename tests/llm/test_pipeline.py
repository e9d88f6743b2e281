"""The pipeline's stages on the smallest tables and on odd rows, and the registry."""

import os

import pytest

import __spark_entry__
import corpus_pipeline
from storelens.llm import catalog

SF = "/root/testdata/sf0.001"


def test_registry():
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in catalog.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(catalog.QUERIES) <= set(names) and "pipeline" in names
    assert set(catalog.SQL) <= set(catalog.QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "personal_data", "packing"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_stages_take_and_give_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert sorted(docs.columns) == sorted(columns)
        assert 0.3 * before < docs.count() <= before, name
        assert docs.select("doc_id").distinct().count() == docs.count() or name != "near_duplicates"
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.select("doc_id").distinct().count() == docs.count()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_stages_survive_odd_rows(spark):
    text = " ".join(f"word{i} and more of it" for i in range(60))
    rows = [(1, text, "en", "s", 5), (1, text, "en", "s", 5), (None, text, None, None, None), (2, None, None, None, None), (3, "", "", "", 0), (4, "x " * 200_000, "q", "q", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.limit(0), docs.withColumn("kept", docs["source"]).withColumn("score", docs["n_chars"])):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, SF)
            assert sorted(out.columns) == sorted(frame.columns)
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, frame, SF).collect()
