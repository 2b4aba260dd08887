"""SimHash near-duplicates through a hierarchical index in Gray order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import materialise, prepare_python, salted_join, stored, whole_row, with_row_key

SHINGLE = 3
MAX_BITS = 3
HASH_SEED = 42
BLOCKS = 4  # blocks of 16 bits: fingerprints within 3 bits agree on one of them
SUB_BLOCKS = 4  # blocks of 12 bits of what is left, for block values that many share
HOT_ROWS = 100_000
SALTS = 8
FAN = 8  # children of an index node
PAIRS = 1 << 20  # node pairs expanded at once
CHUNK_ROWS = 1 << 18
PIECE = 1 << 20  # bytes of a text that are split into words at once


def _words(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, a piece of it at a time; pieces end at white space."""
    at = 0
    while len(text) - at > PIECE:
        end = at + PIECE
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield text[at:end].split()
        at = end
    yield text[at:].split()


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of UTF-8 bytes: a bit is set if over half of the shingles' hashes have it.

    A-Z are lower-cased (``bytes.lower`` leaves other letters alone); words lie between ASCII
    white space. Fewer words than a shingle has are one shingle; no words give 0.
    """
    ones, total, carry = np.zeros(64, np.int64), 0, []
    for piece in _words(text.lower()):
        words = carry + piece
        if len(words) >= shingle:
            parts = zip(*[words[i:] for i in range(shingle)], strict=False)
            digest = xxhash.xxh64_intdigest
            h = np.fromiter((digest(b" ".join(p), HASH_SEED) for p in parts), np.uint64, len(words) - shingle + 1)
            for i in range(0, len(h), 1 << 16):
                ones += np.unpackbits(h[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
            total += len(h)
            words = words[len(words) - shingle + 1 :]
        carry = words
    if not total and carry:
        return xxhash.xxh64_intdigest(b" ".join(carry), HASH_SEED)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big") if total else 0


def _fingerprints(shingle: int):
    def run(batches):
        for b in batches:
            texts = (x.as_py() or "" for x in b.column("t"))
            fps = np.fromiter((fingerprint(t.encode(), shingle) for t in texts), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("_row"), b.column("doc_id"), pa.array(fps.view(np.int64))], names=["_row", "doc_id", "fp"])

    return run


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``_row, doc_id, fp``: the fingerprint of each whole text as a signed long."""
    prepare_python(docs.sparkSession)
    rows = with_row_key(stored(docs), "_row", doc_id=F.col(id_col).cast("long"), t=F.col(text_col))
    return rows.mapInArrow(_fingerprints(shingle), "_row long, doc_id long, fp long")


class GrayIndex:
    """Index over fingerprints of several segments; only pairs inside a segment are joined.

    Fingerprints stand in Gray order inside each segment, so neighbours differ
    in few bits. Each node holds the bits that all fingerprints below it share
    (pattern under mask); FAN neighbours of a segment share a parent.
    """

    def __init__(self, fps: np.ndarray, segment: np.ndarray):
        full = np.full(len(fps), ~np.uint64(0))
        leaf = np.arange(len(fps))
        # per level: pattern, mask, first and last + 1 child, first and last + 1 fingerprint
        self.levels = [(fps, full, leaf, leaf + 1, leaf, leaf + 1)]
        roots = len(np.unique(segment)) if len(fps) else 0
        while len(self.levels[-1][0]) > roots:
            pattern, mask, _, _, lo, hi = self.levels[-1]
            n = len(pattern)
            first = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
            place = np.arange(n) - np.repeat(first, np.diff(np.r_[first, n]))
            start = np.flatnonzero(place % FAN == 0)
            end = np.r_[start[1:], n]
            both, some = np.bitwise_and.reduceat(pattern, start), np.bitwise_or.reduceat(pattern, start)
            shared = np.bitwise_and.reduceat(mask, start) & ~(both ^ some)
            self.levels.append((both & shared, shared, start, end, lo[start], hi[end - 1]))
            segment = segment[start]

    def links(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that connect all fingerprints within ``bits`` of each other in their segment.

        Descends from (root, root). A pair of nodes carries the bits compared so far
        and the differences found; children add those in the bits that
        they share beyond these, and the pair is pruned once they exceed ``bits``. If even
        all bits left could not exceed it, the two groups are joined as a whole.
        """
        top = len(self.levels) - 1
        n = len(self.levels[top][0])
        node = np.arange(n)
        stack = [(top, node, node, np.zeros(n, np.uint64), np.zeros(n, np.int64))]
        out_a, out_b = [], []
        while stack:
            level, a, b, seen, diff = stack.pop()
            pattern, mask, first, last, lo, hi = self.levels[level]
            new = mask[a] & mask[b] & ~seen
            diff = diff + np.bitwise_count((pattern[a] ^ pattern[b]) & new)
            seen = seen | new
            keep = diff <= bits
            a, b, seen, diff = a[keep], b[keep], seen[keep], diff[keep]
            sure = diff + np.bitwise_count(~seen) <= bits
            for x, y in ((a[sure], b[sure]), (b[sure], a[sure])):
                size = hi[y] - lo[y]
                out_a.append(np.repeat(lo[x], size))
                out_b.append(_ranges(lo[y], size))
            if level == 0:
                continue
            a, b, seen, diff = a[~sure], b[~sure], seen[~sure], diff[~sure]
            size_a, size_b = last[a] - first[a], last[b] - first[b]
            cuts = np.searchsorted(np.cumsum(size_a * size_b), np.arange(PAIRS, (size_a * size_b).sum(), PAIRS))
            for part in np.split(np.arange(len(a)), np.unique(cuts)):
                if not len(part):
                    continue
                na, nb = size_a[part], size_b[part]
                count = na * nb
                k = _ranges(np.zeros(len(part), np.int64), count)
                wide = np.repeat(nb, count)
                child_a, child_b = np.repeat(first[a[part]], count) + k // wide, np.repeat(first[b[part]], count) + k % wide
                once = np.repeat(a[part] != b[part], count) | (child_a <= child_b)
                stack.append((level - 1, child_a[once], child_b[once], np.repeat(seen[part], count)[once], np.repeat(diff[part], count)[once]))
        return np.concatenate(out_a or [np.zeros(0, np.int64)]), np.concatenate(out_b or [np.zeros(0, np.int64)])


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] numbers), start[1], ..."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each of n nodes' component under the links a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _join_segments(bits: int):
    def solve(cols: list[np.ndarray]):
        key, fps = np.stack(cols[:4], axis=1), cols[4].view(np.uint64)
        segment = np.cumsum(np.r_[False, (key[1:] != key[:-1]).any(axis=1)])
        a, b = GrayIndex(fps, segment).links(bits)
        root = _roots(len(fps), a, b)
        other = np.flatnonzero(root != np.arange(len(fps)))
        u, v = fps[other].view(np.int64), fps[root[other]].view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    def run(batches):
        held: list[list[np.ndarray]] = []
        rows = 0
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(cols[0]):
                continue
            # what is held may be solved up to the last change of segment
            if rows >= CHUNK_ROWS:
                done = [np.concatenate(c) for c in zip(*held, strict=True)]
                same = np.ones(rows, bool)
                for c in done[:4]:
                    same &= c == c[-1]
                cut = rows - int(np.argmin(same[::-1])) if not same.all() else 0
                if cut:
                    yield solve([c[:cut] for c in done])
                held, rows = [[c[cut:] for c in done]], rows - cut
            held.append(cols)
            rows += len(cols[0])
        if rows:
            yield solve([np.concatenate(c) for c in zip(*held, strict=True)])

    return run


def fingerprint_links(fps: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """Links ``u, v`` that connect all distinct fingerprints (column ``fp``) within ``bits`` <= 3 of each other.

    Each fingerprint goes to 4 segments, one per 16-bit block, by the value of the block; two
    that differ in at most 3 bits share one of them. A segment of over HOT_ROWS is
    dealt out again by 4 blocks of 12 bits of the other 48, by the same argument.
    """
    if bits > BLOCKS - 1:
        raise ValueError(f"{bits} bits need more than {BLOCKS} blocks")
    mask = (1 << 64 // BLOCKS) - 1
    block = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1)))
    turned = F.expr("shiftleft(fp, 16 * block) | shiftrightunsigned(fp, 64 - 16 * block)")
    rows = fps.select("fp", block.alias("block")).withColumn("turned", F.when(F.col("block") == 0, F.col("fp")).otherwise(turned))
    rows = rows.withColumn("value", F.shiftrightunsigned("turned", 48).bitwiseAND(F.lit(mask)))
    hot = rows.groupBy("block", "value").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > HOT_ROWS).select("block", "value", F.lit(True).alias("hot"))
    rows = salted_join(rows, hot, ["block", "value"], ["fp"])
    sub = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SUB_BLOCKS - 1))).otherwise(F.array(F.lit(-1)))
    rows = rows.withColumn("part", F.explode(sub))
    rows = rows.withColumn("sub", F.when(F.col("part") < 0, F.lit(0)).otherwise(F.expr("shiftrightunsigned(turned, 12 * part) & 4095")).cast("long"))
    rank = F.col("turned")
    for s in (1, 2, 4, 8, 16, 32):  # the place of a code word in the Gray sequence: all prefix parities
        rows = rows.withColumn("rank", rank.bitwiseXOR(F.shiftrightunsigned(rank, s)))
        rank = F.col("rank")
    keys = ["block", "value", "part", "sub"]
    dealt = rows.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys, "rank")
    return dealt.select(*[F.col(k).cast("long").alias(k) for k in keys], "fp").mapInArrow(_join_segments(bits), "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """``u, root``: the least node that each linked node can reach, for links ``u, v``.

    Alternates two steps until nothing changes: every node's larger neighbours, then its
    smaller ones, are linked to its least neighbour. Each round writes its links below the
    checkpoint folder. Minima are taken by partial aggregation and joined back over salts, so that
    a node with most of the links is no single task.
    """
    links = materialise(links.where("u <> v").distinct(), "simhash-links")
    state = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = salted_join(both.where("v > u"), least, ["u"], ["v"], salts=SALTS).select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where("u <> v").distinct()
        down = down.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = salted_join(down, least, ["u"], ["v"], salts=SALTS)
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        links = materialise(small.where("u <> v").distinct(), "simhash-links")
        now = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return links.select("u", F.col("v").alias("root"))
        state = now


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, bits: int = MAX_BITS
) -> DataFrame:
    """``_row, doc_id, fp, component_id, keep_row`` for every row of ``docs``.

    Documents whose fingerprints differ in at most ``bits`` bits are linked; a component
    is named by its smallest doc_id, ``keep_row`` is the row that bears it (the first of equal ids).

    Documents of equal fingerprint enter the search as one. Null text counts as empty; texts without words have
    fingerprint 0 and are linked like any other; a null id is larger than any other, and is the
    component's only if all are null; an empty table gives an empty result; other columns are ignored.
    """
    rows = materialise(with_fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    order = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id"), F.col("_row")))
    fps = rows.groupBy("fp").agg(order.alias("first"))
    roots = components(fingerprint_links(fps.select("fp"), bits)).select(F.col("u").alias("fp"), "root")
    # written tables with a row per fingerprint or linked fingerprint are small in their files, not in a broadcast
    named = fps.join(roots.hint("merge"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = named.groupBy("root").agg(F.min("first").alias("best"))
    named = salted_join(named.select("fp", "root"), best, ["root"], ["fp"])
    # two written tables: a fingerprint that many rows share is split by Spark's skew join
    named = materialise(named.select(F.col("fp").alias("_fp"), "best"), "simhash-named")
    out = rows.join(named.hint("merge"), F.col("fp") == F.col("_fp"))
    return out.select("_row", "doc_id", "fp", F.col("best.doc_id").alias("component_id"), F.col("best._row").alias("keep_row"))


def drop_near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with one row of each component (see ``near_duplicates``), all columns kept."""
    docs = stored(docs)
    gone = near_duplicates(docs, **settings).where("_row <> keep_row").select(F.col("_row").alias("_gone"))
    packed = with_row_key(docs, "_row", d=whole_row(docs))
    return packed.join(gone, F.col("_row") == F.col("_gone"), "left_anti").select("d.*")
