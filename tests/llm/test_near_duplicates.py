"""Which rows of near duplicates stay; shards of keys; added columns."""

import pytest
from pyspark.sql import functions as F

from sluice.llm import decontaminate, jaccard_join, warc

SCHEMA = "doc_id long, text string, own int, _own int, leak int, _leak int"


def rows_of(df):
    return sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in df.collect())


def test_rows_go_for_their_own_text(spark):
    text = " ".join(f"w{i}" for i in range(60))
    near, other = text + " end", " ".join(f"v{i}" for i in range(60))
    docs = [
        (1, text), (2, near), (2, other), (3, text), (3, text), (4, other), (None, near), (None, "alone in this table with words"),
        (5, None), (5, None), (6, ""), (7, "few"), (7, "few"), (8, "few"),
    ]
    frame = spark.createDataFrame([(*d, 0, 0, 0, 0) for d in docs], SCHEMA)
    kept = jaccard_join.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    want = [(1, text), (2, other), (None, "alone in this table with words"), (5, None), (5, None), (6, ""), (7, "few")]
    assert rows_of(kept) == rows_of(spark.createDataFrame([(*d, 0, 0, 0, 0) for d in want], SCHEMA))
    assert jaccard_join.drop_near_duplicates(frame.limit(0)).count() == 0
    with pytest.raises(ValueError, match="size class"):
        jaccard_join.ngram_jaccard_components(frame, threshold="0.5")


def test_leaks_go_whatever_the_columns(spark):
    text = " ".join(f"w{i}" for i in range(60))
    frame = spark.createDataFrame([(1, text, 0, 0, 0, 0), (2, "nothing of it", 0, 0, 0, 0)], SCHEMA)
    items = spark.createDataFrame([(9, text)], "item_id long, text string")
    assert [r.doc_id for r in decontaminate.drop_leaks(frame, items).collect()] == [2]


def test_more_shards_than_partitions(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = rows_of(jaccard_join.drop_near_duplicates(docs))
    monkeypatch.setattr(jaccard_join, "SHARD", 5_000)
    monkeypatch.setattr(jaccard_join, "FLUSH", 1_000)
    assert rows_of(jaccard_join.drop_near_duplicates(docs)) == want


def test_base32(spark):
    import base64
    import hashlib

    texts = ["", "a", "ä<b>中", "x" * 9_999]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", warc.base32_sha1(F.col("t")).alias("d"))
    assert all(r.d == base64.b32encode(hashlib.sha1(r.t.encode()).digest()).decode() for r in frame.collect())
