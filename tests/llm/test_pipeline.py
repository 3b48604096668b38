"""The pipeline stage by stage, each held against the operator tests' rules."""

import pandas as pd
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import decontaminate, surrogates

FOLDER = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    copy = docs.where("n_chars BETWEEN 800 AND 2000").orderBy("doc_id").limit(3).withColumn("doc_id", F.col("doc_id") + 700_000)
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "a", 0)], docs.schema)
    docs = docs.unionByName(copy).unionByName(odd)
    before, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, FOLDER)
        assert after.columns == columns, name
        held = after.toPandas()
        assert len(held) <= before.count()
        before = spark.createDataFrame(held.astype(object).where(pd.notnull(held), None), docs.schema)
    assert before.where("doc_id >= 700000").count() == 0
    assert before.groupBy("doc_id").count().where("count > 1").count() == 0
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    assert decontaminate.benchmark_leaks(before, items).count() == 0
    assert before.where("n_chars != length(text)").count() == 0
    was = {r.doc_id: r.text for r in docs.collect()}
    for r in before.collect():
        assert len(list(surrogates.find(r.text))) <= len(list(surrogates.find(was[r.doc_id]))) + 1
        assert not {v for *_, v in surrogates.find(was[r.doc_id])} & {v for *_, v in surrogates.find(r.text)}
    packed = corpus_pipeline.STAGES[-1][1](spark, before, FOLDER)
    assert packed.select("doc_id").distinct().count() == before.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0
