"""Joins that do not depend on how rows spread over keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.session import cut_lineage

ROWS_PER_SALT = 100_000
SALTED_KEYS = 10_000


def spread_join(big: DataFrame, small: DataFrame, key: str, spread_by: list[str], how: str = "inner", salts: int = 32) -> DataFrame:
    """Equi-join on ``key`` in which the rows of a hot key of ``big`` are dealt to ``salts`` tasks.

    ``small`` has at most one row per key and is repeated ``salts`` times; both sides are
    hashed on (key, salt), so the plan is the same whatever the skew and does not
    rely on a run-time re-plan. The repeated side is never broadcast: the planner takes it for as small as it was before.
    """
    left = big.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def hot_keys(big: DataFrame, key: str, rows_per_salt: int = ROWS_PER_SALT, most: int = SALTED_KEYS) -> DataFrame:
    """``(key, _salts)`` of the ``most`` most frequent keys of ``big`` that have over ``rows_per_salt`` rows.

    At most ``most`` rows, so it may be broadcast. A key that is left out has at most 1 / ``most`` of all rows.
    """
    counts = big.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.where(F.col("_n") > rows_per_salt).orderBy(F.desc("_n"), key).limit(most)
    return counts.select(key, F.ceil(F.col("_n") / F.lit(rows_per_salt)).cast("int").alias("_salts"))


def salts_of(big: DataFrame, key: str, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame | None:
    """``hot_keys`` as a written table, or None if no key is hot."""
    hot = cut_lineage(hot_keys(big, key, rows_per_salt))
    return None if hot.isEmpty() else hot


def salts_by_degree(degrees: DataFrame, key: str, count: str, rows_per_salt: int = ROWS_PER_SALT, most: int = SALTED_KEYS) -> DataFrame | None:
    """``salts_of`` from a written table that has each key's number of rows (or a bound on it) in ``count``."""
    hot = degrees.where(F.col(count) > rows_per_salt).orderBy(F.desc(count), key).limit(most)
    hot = cut_lineage(hot.select(key, F.ceil(F.col(count) / F.lit(rows_per_salt)).cast("int").alias("_salts")))
    return None if hot.isEmpty() else hot


def degree_join(
    big: DataFrame, small: DataFrame, key: str, spread_by: list[str], hot: DataFrame | None, how: str = "inner"
) -> DataFrame:
    """Equi-join on ``key`` in which each key has as many salts as ``hot`` (of ``hot_keys``) says, all others one.

    ``small`` has at most one row per key; only the rows of hot keys are repeated, once per salt. Without hot keys
    (``hot`` is None) it is a plain join.
    """
    if hot is None:
        return big.join(small, key, how)
    hot = F.broadcast(hot)
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    left = big.join(hot, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread_by), salts).cast("int")).drop("_salts")
    right = small.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return left.join(right, [key, "_salt"], how).drop("_salt")
