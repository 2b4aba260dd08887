"""Filter interaction audit: what each of five filters removes at each place of each order.

A document is only its failure mask. For a given order it is removed at the first filter it
fails. Orders that begin with the same filters form one interval of lexicographic (Lehmer)
ranks, so each mask's removals are a few intervals: counts are added at the interval ends of a
difference array per (part, step), and a prefix sum over the 120 ranks gives every cell.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kestrel.llm.common import materialise

FILTERS = "ABCDE"
ORDERS = factorial(len(FILTERS))
# word separators of the contract, as a splitting pattern
_GAPS = r"[\x20\x09-\x0D]+"
_EVENTS = ("n", "good", "toxic")


def lehmer_rank(prefix: str) -> int:
    """Rank of the first order, in lexicographic order, that begins with ``prefix``."""
    left, rank = list(FILTERS), 0
    for letter in prefix:
        digit = left.index(letter)
        del left[digit]
        rank += digit * factorial(len(left))
    return rank


def removal_intervals() -> list[tuple[int, int, int, int]]:
    """``(mask, step, first rank, rank after the last)``: where a document of that mask is removed."""
    rows = []
    for mask in range(1, 1 << len(FILTERS)):
        fails = [f for i, f in enumerate(FILTERS) if mask >> i & 1]
        passes = [f for f in FILTERS if f not in fails]
        for step in range(1, len(passes) + 2):
            size = factorial(len(FILTERS) - step)
            for before in permutations(passes, step - 1):
                for f in fails:
                    first = lehmer_rank("".join(before) + f)
                    rows.append((mask, step, first, first + size))
    return rows


def _text_mask(t: Column) -> Column:
    """Bits A to D of the failure mask of a text."""
    words = F.array_remove(F.split(t, _GAPS), "")
    counts = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))[0]
    capitals = F.length(F.regexp_replace(t, "[^A-Z]+", ""))
    return F.transform(
        F.array(counts),
        lambda c: F.when(c["n"] < 50, 1).otherwise(0)
        + F.when(100 * c["d"] < 65 * c["n"], 2).otherwise(0)
        + F.when(100 * capitals > 5 * F.length(t), 4).otherwise(0)
        + F.when(t.rlike(r"[#$%&*|]"), 8).otherwise(0),
    )[0]


def failure_counts(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by failure mask, and how many of them are labelled good or toxic.

    Texts are scanned once and kept as (id, part, SHA-256, mask). A text's least id comes from a partial
    aggregation over digests; it is joined back on (id, digest), so copies of one text do not meet in one task.
    """
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col), F.lit("")).alias("t"),
    )
    base = materialise(base.select("doc_id", "part", F.unhex(F.sha2("t", 256)).alias("digest"), _text_mask(F.col("t")).alias("mask")), "audit-masks")
    known = base.where("doc_id IS NOT NULL").groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    first = base.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = labels.select("doc_id", "quality", "toxic").where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("long")).alias("q"), F.max((F.col("toxic") == 1).cast("long")).alias("x")
    )
    marked = known.join(first, ["doc_id", "digest"], "left").join(marks, "doc_id", "left")
    marked = marked.select(
        "part",
        (F.col("mask") + F.when(F.col("first").isNull(), 16).otherwise(0)).alias("mask"),
        "n",
        (F.col("n") * F.coalesce("q", F.lit(0))).alias("good"),
        (F.col("n") * F.coalesce("x", F.lit(0))).alias("toxic"),
    )
    # a row without an id has no smaller one and no label
    unknown = base.where("doc_id IS NULL").select("part", "mask", F.lit(1).alias("n"), F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return marked.unionByName(unknown).groupBy("part", "mask").agg(*[F.sum(c).cast("long").alias(c) for c in _EVENTS])


def removals(counts: DataFrame) -> DataFrame:
    """``part, rank, step, n, good, toxic``: what is removed at each step of each of the 120 orders, zeros included."""
    spark = counts.sparkSession
    intervals = F.broadcast(spark.createDataFrame(removal_intervals(), "mask int, step int, lo int, hi int"))
    ends = counts.join(intervals, "mask").select(
        "part",
        "step",
        F.explode(F.array(F.struct(F.col("lo").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("hi").alias("rank"), F.lit(-1).alias("sign")))).alias("e"),
        *_EVENTS,
    )
    ends = ends.where(F.col("e.rank") < ORDERS).select("part", "step", "e.rank", *[(F.col("e.sign") * F.col(c)).alias(c) for c in _EVENTS])
    cells = counts.select("part").distinct().select("part", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    cells = cells.select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("rank"), *[F.lit(0).cast("long").alias(c) for c in _EVENTS])
    differences = ends.unionByName(cells).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in _EVENTS])
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return differences.select("part", "rank", "step", *[F.sum(c).over(along).cast("long").alias(c) for c in _EVENTS])


def audit(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """One row per part, order of the filters and step: ``part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley``.

    * null text is empty and fails A alone; an empty text equal to another of a smaller id fails E too;
    * texts are compared by SHA-256 of the whole text; rows of one id do not make each other copies;
    * a null id is never a copy, makes none, and has no label; of several labels of an id a 1 counts;
    * null part is the empty string; other columns are ignored; an empty table gives an empty result;
    * text of any length is one pass of built-in functions.
    """
    counts = materialise(failure_counts(docs, labels, **columns), "audit-counts")
    fails = [F.sum(F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.col("n")).otherwise(0)) for i in range(len(FILTERS))]
    alone = [F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)) for i in range(len(FILTERS))]
    totals = counts.groupBy("part").agg(F.sum("n").alias("total"), F.array(*fails).alias("fails"), F.array(*alone).alias("alone"))
    orders = counts.sparkSession.createDataFrame([(r, "".join(p)) for r, p in enumerate(permutations(FILTERS))], "rank int, filter_order string")
    cells = removals(counts).join(F.broadcast(orders), "rank").withColumn("filter", F.expr("ascii(substring(filter_order, step, 1)) - 64"))
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.withColumn("gone", F.sum("n").over(so_far)).withColumn("shapley", F.sum("n").over(Window.partitionBy("part", "filter")))
    return cells.join(totals, "part").select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.col("gone")).alias("kept"),
        F.col("n").alias("removed"),
        (F.element_at("fails", F.col("filter")) - F.col("n")).alias("redundant"),
        F.element_at("alone", F.col("filter")).alias("unique_fails"),
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        "shapley",
    )


def oracle_sql() -> str:
    """The audit by brute force: every mask walks through every order."""
    letters = "(VALUES ('A', 0), ('B', 1), ('C', 2), ('D', 3), ('E', 4))"
    return rf"""
    WITH marks AS (
      SELECT doc_id, max((quality = 1)::INT) AS q, max((toxic = 1)::INT) AS x FROM labels GROUP BY doc_id),
    texts AS (
      SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    docs AS (
      SELECT part, coalesce(q, 0) AS q, coalesce(x, 0) AS x,
             [len(w) < 50, 100 * list_unique(w) < 65 * len(w),
              100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t),
              regexp_matches(t, '[#$%&*|]'),
              coalesce(texts.doc_id > min(texts.doc_id) OVER (PARTITION BY t), false)] AS fails
      FROM texts LEFT JOIN marks ON texts.doc_id = marks.doc_id),
    masks AS (SELECT part, fails, count(*) AS n, sum(q) AS good, sum(x) AS toxic FROM docs GROUP BY ALL),
    letters(f, i) AS {letters},
    orders AS (
      SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS idx
      FROM letters a, letters b, letters c, letters d, letters e
      WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
    walks AS (
      SELECT part, filter_order, n, good, toxic,
             list_position(list_transform(idx, lambda i: fails[i + 1]), true) AS place
      FROM masks, orders),
    cells AS (
      SELECT part, filter_order, s.step, idx[s.step] AS i FROM (SELECT DISTINCT part FROM masks), orders,
             (VALUES (1), (2), (3), (4), (5)) s(step)),
    gone AS (
      SELECT part, filter_order, place AS step, sum(n) AS removed, sum(good) AS good_lost, sum(toxic) AS toxic_lost
      FROM walks WHERE place IS NOT NULL GROUP BY ALL),
    totals AS (SELECT part, sum(n) AS total FROM masks GROUP BY part),
    single AS (
      SELECT part, i, sum(n) FILTER (fails[i + 1]) AS failing,
             sum(n) FILTER (fails[i + 1] AND len(list_filter(fails, lambda v: v)) = 1) AS alone
      FROM masks, letters GROUP BY part, i),
    joined AS (
      SELECT part, filter_order, step, i, total, coalesce(removed, 0) AS removed, coalesce(good_lost, 0) AS good_lost,
             coalesce(toxic_lost, 0) AS toxic_lost, coalesce(failing, 0) AS failing, coalesce(alone, 0) AS alone
      FROM cells JOIN totals USING (part) JOIN single USING (part, i) LEFT JOIN gone USING (part, filter_order, step))
    SELECT part, filter_order, step::INT AS step,
           (total - sum(removed) OVER (PARTITION BY part, filter_order ORDER BY step))::BIGINT AS kept,
           removed::BIGINT AS removed, (failing - removed)::BIGINT AS redundant, alone::BIGINT AS unique_fails,
           good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
           sum(removed) OVER (PARTITION BY part, i)::BIGINT AS shapley
    FROM joined
    """
