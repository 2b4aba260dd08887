"""Training-corpus pipeline: documents -> clean, unique, mixed, tokenized.

Each stage takes ``(spark, docs, sf_dir)``; ``run`` writes its result as Parquet below
the shared checkpoint folder and reads it again as the next stage's ``docs``.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kestrel.llm import bpe, exact_dedup, mixing, simhash, toxicity
from kestrel.llm.common import materialise, table
from kestrel.llm.queries import BPE_RANKS


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more leave; the model is fitted on the documents that came in."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of fingerprints (3-word shingles, 3 bits) the document with the smallest id stays."""
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out as their source's quota of blocks says."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes, a row per document of the mixture."""
    return bpe.round_trip(docs, public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

# toxicity (a trained model) and the recursive tokenizer have no SQL; tests hold each stage to a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
