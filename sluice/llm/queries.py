"""One registered query per operator, on the driver tables, and the pipeline."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluice.llm.manifest_sql import manifest_sql
from sluice.llm.vector_codes_sql import codes_sql
from sluice.session import shared_folder

# Fixed values of the URL contract.
URL_RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
    ("block", "net/es/"), ("block", "net/fr/"),
)
# A list of hosts as given by a caller; the query derives its own from BLOCKED_SITES.
BLOCKED_HOSTS = (
    "cheap-pills.example.com", "free-bets.example.com", "adult-x.example.net",
    "spam-farm.example.org", "ads-track.example.org", "casino-win.example.org",
)
# Names of junk sites: their labels under any domain ending are the listed hosts.
BLOCKED_SITES = ("cheap-pills", "free-bets", "adult-x", "spam-farm", "ads-track", "casino-win")
VOCABULARY = "byte_bpe_50k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    from sluice.llm.quality_rules import quality_verdicts

    return quality_verdicts(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    from sluice.llm.packing import pack_documents

    return pack_documents(table(spark, folder, "documents"), vocabulary())


def op3_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from sluice.llm.decontaminate import benchmark_leaks

    return benchmark_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    from sluice.llm.html_text import main_texts

    return main_texts(table(spark, folder, "pages"))


def op5_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    from sluice.llm.surrogates import replace_entities

    return replace_entities(table(spark, folder, "documents"))


def op6_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    from sluice.llm.kneser_ney import perplexity_scores

    return perplexity_scores(table(spark, folder, "documents"))


def op7_url_cascade(spark: SparkSession, folder: str) -> DataFrame:
    from sluice.llm.url_cascade import judge_urls, site_hosts

    pages = table(spark, folder, "pages")
    return judge_urls(pages, URL_RULES, site_hosts(pages, BLOCKED_SITES))


def op8_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    from sluice.llm.jaccard_join import ngram_jaccard_components

    return ngram_jaccard_components(table(spark, folder, "documents"))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    from sluice.llm.warc import archived_pages

    return archived_pages(table(spark, folder, "pages"), f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}")


def op10_sentence_spans(spark: SparkSession, folder: str) -> DataFrame:
    from sluice.llm.sentence_spans import remove_repeated_spans

    return remove_repeated_spans(table(spark, folder, "documents"), anywhere=True)


def op11_power_of_two_packing(spark: SparkSession, folder: str) -> DataFrame:
    from sluice.llm.binary_pieces import power_of_two_sequences

    return power_of_two_sequences(table(spark, folder, "documents"), vocabulary())


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    from sluice.llm.merkle import dataset_manifest

    return dataset_manifest(table(spark, folder, "documents"))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    from sluice.llm.vector_codes import vector_codes

    return vector_codes(table(spark, folder, "embeddings"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_best_fit_packing, op3_benchmark_decontamination, op4_html_extraction,
        op5_pii_surrogates, op6_kneser_ney, op7_url_cascade, op8_ngram_jaccard, op9_warc,
        op10_sentence_spans, op11_power_of_two_packing, op12_merkle_manifest, op13_vector_codes,
        pipeline,
    )
}

ORACLE: dict[str, str] = {"op12_merkle_manifest": manifest_sql(), "op13_vector_codes": codes_sql()}
