"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kestrel.llm.common import WORD, hex60, materialise, salted_join, stored, whole_row, with_row_key

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEATS = 2
BLOCK_TOKENS = 1024
BLOCKS_PER_SHARD = 8192
SEED = 42
# least number of blocks of a target; most blocks of a whole table and of one source
LEAST_BLOCKS, BLOCKS, SOURCE_BLOCKS = 64, 1 << 23, 1 << 30
CELLS = 1024
# a prime above 2^31: coprime to any number of blocks below it, so that
# j -> (PRIME * j + offset) mod n is a permutation of the n blocks
PRIME = 2654435761


class Mix(NamedTuple):
    documents: DataFrame  # row key, doc_id, source, size, source_size, target, taken
    quotas: DataFrame  # shard, source, quota (blocks)


def seeded_place(seed: int) -> Column:
    """Place of ``doc_id`` in the seeded order of its source, 60 bits."""
    return hex60(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, max_repeats: int) -> DataFrame:
    """Water-filling of ``share`` x all tokens over the sources.

    ``sizes`` has one row per source (``source, source_size``): a table as long
    as the list of sources, the only one that is ordered as a whole.
    Sources sort by code point, null last; weights repeat in that order.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("src") % len(weights)) + 1).cast("int"))
    t = sizes.withColumn("src", F.row_number().over(by_name) - 1).withColumn("w", w)
    t = t.withColumn("cap", F.col("source_size") * float(max_repeats)).withColumn("total", F.sum("source_size").over(everything))
    t = t.withColumn("ratio", F.col("cap") / F.col("w"))
    order = Window.orderBy("ratio", "src")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    on = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    t = t.withColumn(
        "level",
        (F.col("total") * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(on),
    )
    # the first source that its share does not fill gives the level of all that follow
    free = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "src", "level"))).over(everything)
    t = t.withColumn("free", free["level"])
    return t.select(
        "source",
        "src",
        "source_size",
        "total",
        F.when(F.col("free").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("w") * F.col("free"))).alias("target"),
    )


def _seats(sources: DataFrame) -> DataFrame:
    """One row per awarded seat; a source's seats are dealt in chunks so that a large one is not made in one task."""
    chunk = 65536
    parts = sources.where("seats > 0").select(
        "src", "source", "target", "pool", "wide", "block", "seats", F.explode(F.sequence(F.lit(0), ((F.col("seats") - 1) / chunk).cast("long"))).alias("part")
    )
    first, last = F.col("part") * chunk + 1, F.least(F.col("seats"), (F.col("part") + 1) * chunk)
    return parts.repartition("src", "part").withColumn("k", F.explode(F.sequence(first, last)))


def shard_quotas(sources: DataFrame, blocks_per_shard: int) -> DataFrame:
    """Blocks of each source in each shard: ``shard, src, source, quota``.

    All seats (source, k) are ranked by their quotient target / (2k - 1), for a
    source of smaller blocks target / (2k - 1) x wide / block, highest first, and cut into shards of ``blocks_per_shard``: every prefix of
    shards is then the Sainte-Lague apportionment of its size. The global
    rank comes from buckets of about one shard each (the quotient's rank
    is known within half the number of sources), whose counts are summed.
    """
    seats = _seats(sources).withColumn("key", (F.col("k") - 0.5) * (F.col("block") / F.col("wide")) / F.col("target"))
    seats = seats.withColumn("bucket", F.floor(F.col("key") * F.col("pool") / F.col("wide") / blocks_per_shard).cast("long"))
    counts = seats.groupBy("bucket").agg(F.count(F.lit(1)).alias("c"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("bucket").alias("b"), F.coalesce(F.sum("c").over(before), F.lit(0)).alias("offset"))
    ranked = seats.join(offsets, F.col("bucket") == F.col("b")).withColumn(
        "rank", F.col("offset") + F.row_number().over(Window.partitionBy("bucket").orderBy("key", "src")) - 1
    )
    return ranked.groupBy((F.col("rank") / blocks_per_shard).cast("long").alias("shard"), "src", "source").agg(
        F.count(F.lit(1)).alias("quota")
    )


def taken_tokens(start: Column, size: Column, block: Column, n: Column, quota: Column, seed: int) -> Column:
    """Tokens of [start, start + size) in the selected blocks, repeats counted.

    Block j of a source's n blocks stands at place (PRIME j + seed) mod n of
    the selection order; the quota goes round that order.
    """
    p, whole, rest, base = F.lit(PRIME) % n, F.floor(quota / n).cast("long"), quota % n, F.lit(seed) % n

    def add(acc, j):
        overlap = F.least(start + size, (j + 1) * block) - F.greatest(start, j * block)
        return acc + overlap * (whole + F.when((p * j + base) % n < rest, F.lit(1)).otherwise(F.lit(0)))

    blocks = F.sequence(F.floor(start / block).cast("long"), F.floor((start + size - 1) / block).cast("long"))
    return F.when(size > 0, F.aggregate(blocks, F.lit(0).cast("long"), add)).otherwise(F.lit(0).cast("long"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    max_repeats: int = MAX_REPEATS,
    block_tokens: int = BLOCK_TOKENS,
    blocks_per_shard: int = BLOCKS_PER_SHARD,
    seed: int = SEED,
) -> Mix:
    """Choose how many tokens of each document a mixture takes.

    Tokens are the words of ``WORD``. Each source's documents are laid out in
    a seeded order (MD5 of seed and id) as one run of tokens and cut into blocks
    of equal size; seats of one block each go to the sources by highest
    quotients (``shard_quotas``), as many as have a quotient of a block or more,
    and a source fills its seats from its blocks in seeded order, going
    round again for repeats. Blocks shrink below ``block_tokens`` where the
    smallest target would have under 64 of them, down to 2^-23 of all tokens; a
    source whose target still has under 64 of them gets smaller blocks of its own.

    A source's total differs from its target by two blocks at most. Null text has no
    tokens, a null source is a source, a null id an id; equal rows are separate
    documents that share a place in the order; sources without tokens have target 0;
    an empty table gives an empty result. Other columns are ignored.

    Positions are summed in two steps, over ``CELLS`` cells of each source
    and inside a cell, so that a source holding most rows is spread.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = with_row_key(
        stored(docs),
        "_row",
        doc_id=F.col(id_col),
        source=F.col(source_col).cast("string"),
        size=F.regexp_count(text, F.lit(WORD)).cast("long"),
    ).withColumn("h", seeded_place(seed))
    base = materialise(base.withColumn("cell", F.floor(F.col("h") / F.lit((1 << 60) // CELLS)).cast("int")), "mix-base")

    cells = base.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    sources = source_targets(
        cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")), weights, share, max_repeats
    )
    all_rows = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    least = F.min(F.when(F.col("target") > 0, F.col("target"))).over(all_rows)
    sources = (
        sources.withColumn("pool", F.sum("target").over(all_rows))
        .withColumn("block", F.floor(F.greatest(least / LEAST_BLOCKS, F.col("total") / BLOCKS)).cast("long"))
        .withColumn("wide", F.coalesce(F.greatest(F.lit(1), F.least(F.lit(block_tokens), F.col("block"))), F.lit(1)).cast("long"))
        .withColumn("own", F.greatest(F.lit(1), F.floor(F.col("target") / LEAST_BLOCKS), F.ceil(F.col("source_size") / SOURCE_BLOCKS)))
        .withColumn("block", F.least("wide", "own").cast("long"))
        .withColumn("seats", F.floor(F.col("target") / F.col("block") + 0.5).cast("long"))
    )
    sources = materialise(sources, "mix-sources")
    quotas = shard_quotas(sources, blocks_per_shard)
    totals = quotas.groupBy("src").agg(F.sum("quota").alias("quota"))
    sources = sources.join(totals, "src", "left").select(
        F.col("source").alias("s"),
        "source_size",
        "target",
        "block",
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.col("block"))).cast("long").alias("n"),
        F.coalesce("quota", F.lit(0)).alias("quota"),
    )
    before = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("cell_start", F.coalesce(F.sum("cell_size").over(before), F.lit(0)))
    cells = cells.join(sources, F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("source").alias("s"), F.col("cell").alias("c"), "cell_start", "source_size", "target", "block", "n", "quota"
    )
    inside = Window.partitionBy("source", "cell").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = base.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        cells, F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c"))
    )
    start = F.col("cell_start") + F.col("inside")
    documents = placed.select(
        "_row",
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        taken_tokens(start, F.col("size"), F.col("block"), F.col("n"), F.col("quota"), seed).alias("taken"),
    )
    return Mix(documents, quotas.select("shard", "source", "quota"))


def whole_copies(plan: DataFrame) -> DataFrame:
    """Whole copies of each row of ``plan`` (``_row, h, doc_id, source, size, taken``): ``_r, _copies``.

    A document gets floor(taken / size) copies. The words that this leaves of a
    source are filled by one more copy of some of the documents that have a
    rest: they queue by (place in the seeded order) / (rest / size), so that the
    chance of a copy is about rest / size whatever the size, and all enter whose middle
    lies within the words left. A source's copied words thus differ from its taken
    words by half a document at most, and no document has more than ceil(taken / size) copies.

    The queue is summed over ``CELLS`` cells of each source; only the one cell in which it ends is ordered.
    """
    rows = plan.withColumn("whole", F.floor(F.col("taken") / F.col("size")).cast("long"))
    rows = rows.withColumn("rest", F.col("taken") - F.col("whole") * F.col("size"))
    key = (F.col("h") + 0.5) / float(1 << 60) * F.col("size") / F.col("rest")
    rows = rows.withColumn("key", F.when(F.col("rest") > 0, key))
    # the queue ends near 1
    rows = materialise(rows.withColumn("cell", F.floor(F.least(F.col("key"), F.lit(2.0)) * (CELLS // 2)).cast("int")), "mix-copies")

    cells = rows.where("rest > 0").groupBy("source", "cell").agg(F.sum("size").alias("cell_size"), F.sum("rest").alias("cell_rest"))
    by_source = Window.partitionBy("source")
    cells = cells.withColumn("upto", F.sum("cell_size").over(by_source.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    cells = cells.withColumn("words_left", F.sum("cell_rest").over(by_source))
    last = cells.where("upto - cell_size <= words_left AND words_left < upto").select(
        "source", F.col("cell").alias("last_cell"), (F.col("words_left") - F.col("upto") + F.col("cell_size")).alias("room")
    )
    rows = salted_join(rows, last, ["source"], ["_row"])
    in_last = F.coalesce(F.col("cell") == F.col("last_cell"), F.lit(False))
    before = Window.partitionBy("source", "cell").orderBy("key", "doc_id", "size", "_row").rowsBetween(Window.unboundedPreceding, -1)
    edge = rows.where(in_last).withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    more = {False: F.coalesce(F.col("cell") < F.col("last_cell"), F.lit(False)), True: F.col("start") + F.col("size") / 2 <= F.col("room")}
    counted = lambda df, at: df.select(F.col("_row").alias("_r"), (F.col("whole") + more[at].cast("int")).cast("int").alias("_copies"))
    return counted(rows.where(~in_last), False).unionByName(counted(edge, True))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mixture as documents: each row of ``docs`` repeated in whole copies, ``whole_copies`` of its tokens taken.

    Documents without words are in no block and leave. All columns are kept.
    """
    docs = stored(docs)
    plan = mix(docs, **settings).documents.where("taken > 0").withColumn("h", seeded_place(settings.get("seed", SEED)))
    plan = whole_copies(plan).where("_copies > 0")
    packed = with_row_key(docs, "_row", d=whole_row(docs))
    return (
        packed.join(plan, F.col("_row") == F.col("_r"))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select("d.*")
    )


def oracle_sql() -> str:
    """The whole mixture in one DuckDB statement, with plain windows in place of cells and shards."""
    weights = ", ".join(f"{float(x)}" for x in WEIGHTS)
    return f"""
    WITH base AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
             ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS h
      FROM documents),
    s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM base GROUP BY source),
    s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS src FROM s0),
    s2 AS (SELECT *, list_extract([{weights}], ((src % {len(WEIGHTS)}) + 1)::INT)::DOUBLE AS w,
                  source_size::DOUBLE * {MAX_REPEATS} AS cap, sum(source_size) OVER ()::DOUBLE AS total FROM s1),
    s3 AS (SELECT *, cap / w AS ratio FROM s2),
    s4 AS (SELECT *, (total * {SHARE}::DOUBLE - coalesce(sum(cap) OVER (ORDER BY ratio, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                  / sum(w) OVER (ORDER BY ratio, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s3),
    s5 AS (SELECT *, (SELECT level FROM s4 WHERE ratio >= level ORDER BY ratio, src LIMIT 1) AS free_level FROM s4),
    s6 AS (SELECT *, CASE WHEN free_level IS NULL THEN cap ELSE least(cap, w * free_level) END AS target FROM s5),
    s7 AS (SELECT *, coalesce(greatest(1, least({BLOCK_TOKENS},
                  floor(greatest(min(target) FILTER (WHERE target > 0) OVER () / 64, total / {1 << 23})))), 1)::BIGINT AS block FROM s6),
    s8 AS (SELECT *, floor(target / block + 0.5)::BIGINT AS quota,
                  greatest(1, ceil(source_size / block))::BIGINT AS n FROM s7),
    placed AS (
      SELECT b.doc_id, b.size, s.source_size, s.target, s.block, s.n, s.quota,
             coalesce(sum(b.size) OVER (PARTITION BY b.source ORDER BY b.h, b.doc_id, b.size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
      FROM base b JOIN s8 s ON b.source IS NOT DISTINCT FROM s.source),
    parts AS (
      SELECT *, unnest(CASE WHEN size > 0 THEN range(start // block, (start + size - 1) // block + 1) ELSE [NULL] END) AS j,
             row_number() OVER () AS r FROM placed)
    SELECT doc_id, size, any_value(source_size) AS source_size, any_value(target) AS target,
           coalesce(sum((least(start + size, (j + 1) * block) - greatest(start, j * block))
             * (quota // n + CASE WHEN (({PRIME} % n) * j + {SEED} % n) % n < quota % n THEN 1 ELSE 0 END)), 0)::BIGINT AS taken
    FROM parts GROUP BY r, doc_id, size
    """
