"""Document fingerprints from closed syncmers of words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kestrel.llm.common import let

K = 3  # words in a k-mer
SKETCH = 64  # hashes in a fingerprint
# a unit is a word, or 16 characters of a longer run without blanks
UNIT = r"[^\x20\x09-\x0D]{1,16}"
ROWS_PER_BUCKET = 2000
FINE = 128  # at most FINE * FINE buckets


def syncmers(text: Column, k: int = K) -> Column:
    """Array of (hash, pos) of the closed syncmers of a text, in text order.

    A k-mer of words is chosen where its least word (by hash) is its first or
    last one. The choice looks at the k words alone, so a passage has the same
    anchors wherever it stands. A text of 1 to k - 1 words is one anchor; a text without words has none.
    """
    units = F.regexp_extract_all(text, F.lit(UNIT), F.lit(0))

    def anchors(h):
        at = F.filter(
            F.sequence(F.lit(0), F.size(h) - k),
            lambda i: F.least(h[i], h[i + (k - 1)]) <= F.array_min(F.slice(h, i + 1, k)),
        )
        chosen = F.transform(at, lambda i: F.struct(F.xxhash64(*[h[i + j] for j in range(k)]).alias("hash"), i.alias("pos")))
        whole = F.array(F.struct(F.xxhash64(h).alias("hash"), F.lit(0).alias("pos")))
        return F.when(F.size(h) >= k, chosen).when(F.size(h) > 0, whole).otherwise(F.slice(whole, 1, 0))

    return let(F.transform(units, lambda w: F.xxhash64(w)), anchors)


def sketch(anchors: Column, size: int = SKETCH) -> Column:
    """The ``size`` least distinct 32-bit anchor hashes, ascending."""
    low = F.transform(anchors, lambda a: a["hash"].bitwiseAND(F.lit(0xFFFFFFFF)))
    return F.slice(F.array_sort(F.array_distinct(low)), 1, size)


def as_text(hashes: Column) -> Column:
    """A sketch as text: 8 hex digits a hash."""
    return F.array_join(F.transform(hashes, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(a: Column, b: Column, size: int = SKETCH) -> Column:
    """Estimated share of anchors that two texts have in common, 0 to 1: half the anchors shared give 0.5.

    The Jaccard likeness J is estimated on the least hashes of the union; the share (Dice) is 2 J / (1 + J).
    Two empty sketches are alike.
    """
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, size)
    shared = let(union, lambda u: F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.greatest(F.size(u), F.lit(1)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(2 * shared / (1 + shared))


def shared_anchors(a: Column, b: Column) -> Column:
    """Positional matches of two ``syncmers`` arrays: array of (pos_a, pos_b) of anchors that occur once in each."""
    def once(x):
        return F.filter(x, lambda y: F.size(F.filter(x, lambda z: z["hash"] == y["hash"])) == 1)

    def match(u, v):
        both = F.array_intersect(F.transform(u, lambda x: x["hash"]), F.transform(v, lambda x: x["hash"]))
        pos = lambda x, h: F.filter(x, lambda y: y["hash"] == h)[0]["pos"]
        return F.transform(both, lambda h: F.struct(pos(u, h).alias("pos_a"), pos(v, h).alias("pos_b")))

    return let(once(a), lambda u: let(once(b), lambda v: match(u, v)))


def _at_or_below(col: Column, splits: list[int]) -> Column:
    """Number of the ascending ``splits`` at or below a value, by two steps of at most FINE comparisons."""
    none = F.array().cast("array<bigint>")
    longs = lambda xs: F.array(*map(F.lit, xs)).cast("array<bigint>") if xs else none
    coarse = longs(splits[FINE - 1 :: FINE])
    fine = F.array(*[longs(splits[i : i + FINE]) for i in range(0, len(splits), FINE)], none)
    block = F.size(F.filter(coarse, lambda s: s <= col))
    return block * FINE + F.size(F.filter(fine[block], lambda s: s <= col))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``doc_id, t, next_t``: each text with that of the next row in descending id order, the last with the first.

    Rows are dealt to ranges of ids of about equal size, whose bounds (16,384 at
    most) are quantiles of the ids; the first row of each range also visits the range
    before it. One shuffle of the texts; no task sees more than a range. Null
    ids come last, null texts are empty; rows of equal id are ordered by text.
    """
    ids = docs.select(F.col(id_col).cast("long").alias("i"))
    n = ids.count()
    buckets = min(FINE * FINE, -(-n // rows_per_bucket))
    splits: list[int] = []
    if buckets > 1:
        at = [i / buckets for i in range(1, buckets)]
        splits = sorted(set(ids.agg(F.percentile_approx("i", at, 10 * buckets).alias("q")).first()["q"] or []))
    i = F.col("i")
    ranges = F.when(i.isNull(), F.lit(len(splits) + 1)).otherwise(F.lit(len(splits)) - _at_or_below(i, splits)).cast("int")
    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).withColumn("b", ranges)
    # one row per range: 16,386 at most
    heads = sorted((r["b"], r["i"]) for r in ids.withColumn("b", ranges).groupBy("b").agg(F.max("i").alias("i")).collect())
    visits = [(head, heads[k - 1][0]) for k, (_, head) in enumerate(heads)]
    visits = docs.sparkSession.createDataFrame(visits, "head long, host int")
    places = F.filter(
        F.array(F.struct(F.col("b").alias("b"), F.lit(False).alias("guest")), F.struct(F.col("host").alias("b"), F.lit(True).alias("guest"))),
        lambda x: x["b"].isNotNull(),
    )
    dealt = rows.join(F.broadcast(visits), i.eqNullSafe(F.col("head")), "left").select("i", "t", F.explode(places).alias("p"))
    order = Window.partitionBy("b").orderBy("guest", i.desc_nulls_last(), "t")
    led = dealt.select("i", "t", "p.b", "p.guest").withColumn("next_t", F.lead("t").over(order))
    return led.where("NOT guest").select(i.alias("doc_id"), "t", "next_t")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, size: int = SKETCH) -> DataFrame:
    """Fingerprint each text and its edited text, and compare.

    The edited text has the last floor(n / 2) code points of the n replaced by as many
    of the first of the next document (``with_next``), or all it has. Returns ``doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    Texts that are equal have equal fingerprints; a text without words has the empty one, which is alike
    (1.0) to itself and unlike (0.0) to any other. An empty table gives an empty result; other columns are ignored.
    """
    half = F.floor(F.char_length("t") / 2).cast("int")
    edited = F.concat(F.left("t", F.char_length("t") - half), F.left("next_t", half))
    rows = with_next(docs, id_col, text_col).withColumn("e", edited)
    rows = rows.select(
        "doc_id",
        F.char_length("t").cast("long").alias("n_chars"),
        F.sha2("e", 256).alias("edited_sha256"),
        *[sketch(syncmers(F.col(c), k), size).alias(f"s_{c}") for c in ("t", "e", "next_t")],
    )
    a, b, c = F.col("s_t"), F.col("s_e"), F.col("s_next_t")
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(a).alias("fingerprint"),
        as_text(b).alias("edited_fingerprint"),
        likeness(a, b, size).alias("near_edited"),
        likeness(a, c, size).alias("near_next"),
    )
