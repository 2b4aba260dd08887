"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import salted_join, stored, whole_row, with_row_key

PREFIX_CHARS = 128


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row per document: ``_row, doc_id, keep_id, group_size, kept, text_sha256``.

    Rows are grouped by byte length; groups of several rows by the hash of
    their first ``prefix_chars`` characters; groups that remain by the SHA-256 of
    the full text, which is the only step that decides. Rows alone in their
    group at an earlier step leave there. In the grouping only survivors are
    hashed in full; the digest of every other row is computed for the output
    column and is dropped by column pruning where that is not selected.

    * null text counts as empty; empty texts are equal to each other;
    * of equal texts the row with the largest id stays, a null id being the
      smallest; of rows equal in text and id exactly one stays;
    * other columns of ``docs`` are ignored, so their names cannot clash;
    * an empty table gives an empty result.

    ``_row`` is the row key of ``with_row_key(docs)``. A hot length, prefix or text is counted
    by partial aggregation and joined back over salts.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = with_row_key(stored(docs), "_row", doc_id=F.col(id_col), t=text).select(
        "_row",
        "doc_id",
        F.octet_length("t").alias("n"),
        F.xxhash64(F.left("t", F.lit(prefix_chars))).alias("p"),
        F.sha2("t", 256).alias("text_sha256"),
    )
    same_length = rows.groupBy("n").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("n")
    left1 = salted_join(rows, same_length, ["n"], ["_row"], "left_semi")
    same_prefix = left1.groupBy("n", "p").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("n", "p")
    left2 = salted_join(left1, same_prefix, ["n", "p"], ["_row"], "left_semi")
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id"), F.col("_row"))
    groups = (
        left2.groupBy("n", "text_sha256")
        .agg(F.max(order).alias("keep"), F.count(F.lit(1)).alias("c"))
        .where("c > 1")
    )
    out = salted_join(rows, groups, ["n", "text_sha256"], ["_row"], "left")
    alone = F.col("c").isNull()
    return out.select(
        "_row",
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce(F.col("c"), F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("keep._row") == F.col("_row"))).alias("kept"),
        "text_sha256",
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts (see ``duplicate_groups``), all columns kept."""
    docs = stored(docs)
    dropped = duplicate_groups(docs, id_col, text_col).where("NOT kept").select(F.col("_row").alias("_gone"))
    packed = with_row_key(docs, "_row", d=whole_row(docs))
    return packed.join(dropped, F.col("_row") == F.col("_gone"), "left_anti").select("d.*")
