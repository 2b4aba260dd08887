"""Registered queries of this folder and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import (
    bpe,
    exact_dedup,
    filter_audit,
    html_extract,
    language_crf,
    license_rules,
    mixing,
    simhash,
    spelling,
    suffix_dedup,
    syncmers,
    toxicity,
    url_reputation,
)
from kestrel.llm.common import table

BPE_RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.scan(table(spark, sf_dir, "documents"))


def op2_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents")).documents
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op4_suffix_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("_row")


def op5_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)


def op7_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprint_edits(table(spark, sf_dir, "documents"))


def op8_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.sample_model(docs, table(spark, sf_dir, "labels"))).drop("_row")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents")).drop("_row")


def op10_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    outcomes = url_reputation.page_outcomes(pages, table(spark, sf_dir, "labels"))
    return url_reputation.filter_urls(pages, outcomes).withColumn("upper", F.round("upper", 9))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_crf.predict(docs, language_crf.sample_model(docs))


QUERIES = {
    "op1_license_rules": op1_license_rules,
    "op2_html_blocks": op2_html_blocks,
    "op3_mix_sources": op3_mix_sources,
    "op4_suffix_runs": op4_suffix_runs,
    "op5_simhash_gray": op5_simhash_gray,
    "op6_bpe_round_trip": op6_bpe_round_trip,
    "op7_syncmer_fingerprints": op7_syncmer_fingerprints,
    "op8_weak_toxicity": op8_weak_toxicity,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_url_reputation": op10_url_reputation,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_filter_audit": op12_filter_audit,
    "op13_language_crf": op13_language_crf,
}

ORACLE = {
    "op1_license_rules": license_rules.oracle_sql(),
    "op3_mix_sources": mixing.oracle_sql(),
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
    "op10_url_reputation": url_reputation.oracle_sql(),
    "op12_filter_audit": filter_audit.oracle_sql(),
}
