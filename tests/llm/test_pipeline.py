"""The pipeline's stages, each held against its operator or brute force."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import decontamination, neardup, quality, sentencepiece_stream

corpus_pipeline = pytest.importorskip("corpus_pipeline")
DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").withColumn("rep", F.lit("x"))
    columns = docs.columns
    labels = {r.doc_id: r for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    steps = dict(corpus_pipeline.STAGES)
    before = docs.cache()
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, DATA).cache()
        assert after.columns == columns
        ids, was = {r.doc_id for r in after.select("doc_id").collect()}, {r.doc_id for r in before.select("doc_id").collect()}
        assert ids <= was
        kept[name] = ids
        if name == "quality":
            assert all(i in ids for i, r in labels.items() if r.quality == 1)
            assert not any(r.quality == 0 for i, r in labels.items() if i in ids)
        elif name == "near_dedup":
            assert ids == {r.doc_id for r in neardup.near_duplicates(before).where("kept").collect()}
            assert after.count() == len(ids)
        elif name == "decontaminate":
            bench = spark.read.parquet(f"{DATA}/benchmark.parquet")
            assert was - ids == {r.doc_id for r in decontamination.contamination(before, bench).where("contaminated").collect()}
            assert decontamination.contamination(after, bench).where("contaminated").count() == 0
        else:
            assert ids == was and after.where(F.col("text").rlike(r"[A-Za-z0-9]@[a-z0-9]+\.")).count() == 0
        before = after
    out = steps["tokenise"](spark, before, DATA)
    back = {r.doc_id: r.text for r in sentencepiece_stream.decode_documents(out).collect()}
    assert back == {r.doc_id: r.text for r in before.collect()} and out.where("not round_trip").count() == 0
    assert quality.LABELLERS


def test_empty_and_odd(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    data = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "a fine short text of the kind that people write.", "en", "s", 1), (3, "a fine short text of the kind that people write.", "en", "s", 1)]
    for rows in ([], data):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, DATA)
        assert [r.doc_id for r in docs.collect()] == ([3] if rows else [])
