"""Documents to training sequences, stage by stage.

`STAGES` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame
that is written as Parquet and read again as the next one's documents. All but the last return the
columns of `documents`. Rows with null ids, repeated rows, null texts and empty tables pass through
each stage by the rules of its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.decontaminate import drop_leaks
from sluice.llm.jaccard_join import drop_near_duplicates
from sluice.llm.packing import pack_documents
from sluice.llm.quality_rules import keep_good
from sluice.llm.queries import table, vocabulary
from sluice.llm.surrogates import replace_texts
from sluice.session import cut_lineage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned rules keep."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, Jaccard 0.8) the first row: smallest id,
    null last, and of one id the smallest hash of the text. Rows without words are no duplicates."""
    return drop_near_duplicates(docs, n=5, threshold="0.8")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates in place of personal data; n_chars follows the text."""
    changed = replace_texts(docs)
    return changed.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 tokens."""
    return pack_documents(docs, vocabulary())


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("pii_surrogates", private_data),
    ("best_fit_packing", packing),
]

ORACLE_SQL = None  # learned rules and token ids are outside SQL; tests hold it against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
