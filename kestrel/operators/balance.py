"""Splitting and class balancing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.columns import whole_division
from kestrel.operators.profile import _q

HASHES = 1 << 32


def split_hash(keys: list[str]):
    """First 32 bits of the md5 over the key text, 0 .. 2^32 - 1.

    Deterministic across runs, engines and partitionings (``randomSplit`` is
    not: it depends on partition order and re-evaluates its parent).
    """
    k = F.concat_ws("|", *[F.col(_q(c)).cast("string") for c in keys])
    return F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast(T.LongType())


def split_side(keys: list[str], train_fraction: float):
    """True for rows of the training side: those whose hash is below the fraction of all hashes."""
    if not 0.0 <= train_fraction <= 1.0:
        raise ValueError(f"a fraction lies between 0 and 1, got {train_fraction}")
    return split_hash(keys) < F.lit(int(round(train_fraction * HASHES)))


def hash_split(df: DataFrame, keys: list[str], train_fraction: float = 0.7):
    """reproducible split ``(train, test)``; rows that share a key share a side."""
    side = split_side(keys, train_fraction)
    return df.where(side), df.where(~side)


def random_split(df: DataFrame, weights=(0.7, 0.3), seed: int = 42):
    """F5 variant: Spark's sampler with a mandatory seed."""
    return df.randomSplit(list(weights), seed=seed)


def replicate(df: DataFrame, k: int) -> DataFrame:
    """Every row ``k`` times (explode of a literal sequence; no join)."""
    if k < 1:
        raise ValueError("k must be >= 1")
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(int(k))))).drop("_copy")


def label_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """M9/A4: rows per label value."""
    return df.groupBy(F.col(_q(label))).agg(F.count(F.lit(1)).alias("n"))


def oversample_ratio(counts: dict) -> int:
    """``floor(major / minor) + 1``; the minority always ends above the majority."""
    if len(counts) < 2 or min(counts.values()) == 0:
        raise ValueError(f"oversampling needs two non-empty classes, got {counts}")
    return int(max(counts.values()) // min(counts.values())) + 1


def class_ratio(df: DataFrame, label: str = "label") -> DataFrame:
    """A7 as a table: one row ``(major, minor, ratio)`` with the ratio of ``oversample_ratio``."""
    counts = label_counts(df.where(F.col(_q(label)).isNotNull()), label)
    both = counts.agg(F.max("n").alias("major"), F.min("n").alias("minor"))
    return both.withColumn("ratio", whole_division("major", "minor") + 1)


MAX_CLASSES = 10_000


def oversample(df: DataFrame, label: str = "label") -> DataFrame:
    """The minority class ``ratio`` times, the other rows once, in one scan.

    The classes are found by count (one small grouped job; the per-class
    counts reach the driver, MAX_CLASSES at most, or the column is no label), not
    fixed to 1. Rows with a NULL label drop out, as in an equality filter.
    """
    known = df.where(F.col(_q(label)).isNotNull())
    rows = label_counts(known, label).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label!r} has over {MAX_CLASSES} values: not a class label")
    counts = {r[0]: r["n"] for r in rows}
    ratio = oversample_ratio(counts)
    minority = min(counts, key=lambda v: (counts[v], v))
    copies = F.when(F.col(_q(label)) == F.lit(minority), F.lit(ratio)).otherwise(F.lit(1))
    return known.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")
