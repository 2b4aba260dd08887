"""Spelling variant grouping: words one edit apart, found by k-d trees over letter-count vectors.

A replaced letter moves a word's letter counts by one down and one up (L1 distance 2, equal
length), an inserted one by one up (distance 1, length one more). So all near pairs lie between
words of equal length at distance 2 and words of successive lengths at distance 1. A k-d tree
over the counts is searched with the needed steps up and down of each box as pruning bounds;
pairs at the right distance are verified letter by letter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import materialise, prepare_python
from kestrel.operators.joins import degree_join, hot_keys

MIN_LETTERS, MIN_COUNT = 5, 3
EDIT_MODULUS = 97
FLUSH_WORDS, FLUSH_CHARS = 400_000, 1 << 23  # a task's partial counts go out beyond either
REGION = 8192  # words that one task searches at once
REGION_CHARS = 1 << 26
REGIONS = 2048  # regions of a whole table; beyond REGION x REGIONS words regions grow instead
SAMPLE = 32  # words per region from which the routing trees are made
LEAF = 24
QUERIES = 8192  # queries that walk a tree at once
GATHER = 1 << 24  # bytes of letters compared at once


# words of the documents


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run = re.compile(f"[a-zÀ-ÿ]{{{MIN_LETTERS},}}")  # shorter runs give no word
    counts: dict[str, int] = {}
    chars = 0

    def out():
        return pa.RecordBatch.from_pydict({"word": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())})

    for batch in batches:
        for doc_id, text in zip(batch.column("d").to_pylist(), batch.column("t"), strict=True):
            start = zlib.crc32(f"{doc_id}:".encode())
            low = (text.as_py() or "").encode().lower().decode()  # bytes.lower changes A-Z alone
            for w, k in Counter(run.findall(low)).items():
                h = zlib.crc32(w.encode(), start)
                if h % EDIT_MODULUS == 0:
                    at = h % len(w)
                    w = w[:at] + w[at + 1 :]
                    if len(w) < MIN_LETTERS:
                        continue
                if w in counts:
                    counts[w] += k
                else:
                    counts[w] = k
                    chars += len(w)
            if len(counts) > FLUSH_WORDS or chars > FLUSH_CHARS:
                yield out()
                counts.clear()
                chars = 0
    if counts:
        yield out()


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n``: words of at least MIN_LETTERS letters with at least ``min_count`` occurrences in all documents.

    A run of letters of a document loses a letter where the CRC-32 of ``<doc_id>:<run>`` is divisible by
    EDIT_MODULUS. Null text has no words; a null id is written as nothing; a run of any length is one word.
    """
    prepare_python(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("d"), F.col(text_col).alias("t"))
    return rows.mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# k-d tree


def letter_counts(words: list[bytes], letters: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter matrix, counts per letter and the letters counted, of Latin-1 words of one length.

    With ``letters`` given, counts of all other letters are in one more column at the end.
    """
    text = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)
    counts = np.stack([np.bincount(row, minlength=256) for row in text]) if text.shape[1] > 256 else np.bincount(
        (np.arange(len(words))[:, None] * 256 + text).ravel(), minlength=256 * len(words)
    ).reshape(-1, 256)
    if letters is None:
        letters = np.flatnonzero(counts.any(axis=0))
        return text, np.hstack([counts[:, letters], np.zeros((len(words), 1), counts.dtype)]), letters
    known = counts[:, letters]
    return text, np.hstack([known, (text.shape[1] - known.sum(axis=1))[:, None]]), letters


class KdTree:
    """K-d tree over integer count vectors; a leaf holds up to ``leaf`` vectors, or more that are all equal."""

    def __init__(self, counts: np.ndarray, leaf: int):
        self.width = counts.shape[1]
        self.nodes: list[tuple[int, int, int, int]] = []  # dimension, cut, left, right; a leaf: -1, its number
        self.leaves: list[np.ndarray] = []
        self._grow(counts, leaf)

    def _grow(self, counts: np.ndarray, leaf: int) -> None:
        open_ = [(np.arange(len(counts)), -1, 0)]
        while open_:
            ids, parent, side = open_.pop()
            me = len(self.nodes)
            if parent >= 0:
                dim, cut, left, right = self.nodes[parent]
                self.nodes[parent] = (dim, cut, me, right) if side == 0 else (dim, cut, left, me)
            split = self._split(counts[ids]) if len(ids) > leaf else None
            if split is None:
                self.nodes.append((-1, len(self.leaves), 0, 0))
                self.leaves.append(ids)
                continue
            dim, cut = split
            self.nodes.append((dim, cut, 0, 0))
            low = counts[ids, dim] <= cut
            open_ += [(ids[low], me, 0), (ids[~low], me, 1)]

    @staticmethod
    def _split(counts: np.ndarray) -> tuple[int, int] | None:
        """The dimension that its mean divides most evenly; None where all vectors are equal."""
        cuts = np.floor(counts.mean(axis=0)).astype(counts.dtype)
        share = np.abs((counts <= cuts).mean(axis=0) - 0.5)
        dim = int(np.argmin(share))
        return None if share[dim] == 0.5 else (dim, int(cuts[dim]))

    def search(self, queries: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, queries) whose boxes are at most ``up`` letters more and ``down`` letters less away."""
        zero = np.zeros(len(queries), np.int64)
        none, all_ = np.full(self.width, -1, np.int64), np.full(self.width, np.iinfo(np.int64).max)
        open_ = [(0, np.arange(len(queries)), zero, zero, none, all_)]
        while open_:
            node, ids, more, less, lo, hi = open_.pop()
            dim, cut, left, right = self.nodes[node]
            if dim < 0:
                yield cut, ids
                continue
            q = queries[ids, dim]
            fall = less + np.maximum(q - cut, 0) - np.maximum(q - hi[dim], 0)
            rise = more + np.maximum(cut + 1 - q, 0) - np.maximum(lo[dim] - q, 0)
            near = fall <= down
            if near.any():
                top = hi.copy()
                top[dim] = cut
                open_.append((left, ids[near], more[near], fall[near], lo, top))
            near = rise <= up
            if near.any():
                bottom = lo.copy()
                bottom[dim] = cut + 1
                open_.append((right, ids[near], rise[near], less[near], bottom, hi))

    def place(self, points: np.ndarray) -> np.ndarray:
        """The leaf that each vector belongs to."""
        found = np.zeros(len(points), np.int64)
        open_ = [(0, np.arange(len(points)))]
        while open_:
            node, ids = open_.pop()
            dim, cut, left, right = self.nodes[node]
            if dim < 0:
                found[ids] = cut
                continue
            low = points[ids, dim] <= cut
            open_ += [(left, ids[low]), (right, ids[~low])]
        return found


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` become those of ``b`` by one replaced letter, or by one inserted where ``b`` is longer."""
    n = a.shape[1]
    if b.shape[1] == n:
        return (a != b).sum(axis=1) == 1
    before, after = a != b[:, :-1], a != b[:, 1:]
    head = np.where(before.any(axis=1), before.argmax(axis=1), n)
    tail = np.where(after.any(axis=1), after[:, ::-1].argmax(axis=1), n)
    return head + tail >= n


class Region:
    """Words of one length in a k-d tree, searched for words one edit away."""

    def __init__(self, words: list[str], leaf: int = LEAF):
        self.words = words
        self.text, counts, self.letters = letter_counts([w.encode("latin-1") for w in words])
        self.tree = KdTree(counts, leaf)
        self.points = [(ids, counts[ids].astype(float), (counts[ids].astype(float) ** 2).sum(axis=1)) for ids in self.tree.leaves]

    def near(self, queries: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, word) places of pairs one edit apart; the queries are as long as the words, or one letter shorter."""
        text, counts, _ = letter_counts([w.encode("latin-1") for w in queries], self.letters)
        same = text.shape[1] == self.text.shape[1]
        real = counts.astype(float)
        square = (real**2).sum(axis=1)
        step = max(1, GATHER // self.text.shape[1])
        for leaf, ids in self.tree.search(counts, 1, 1 if same else 0):
            words, points, squares = self.points[leaf]
            for lo in range(0, len(words), 4096):
                part = slice(lo, lo + 4096)
                # with lengths given, a squared distance of 2 (or 1) is a step down and one up (or one up) exactly
                apart = square[ids][:, None] + squares[part][None, :] - 2 * real[ids] @ points[part].T
                q, p = np.nonzero(apart == (2 if same else 1))
                for at in range(0, len(q), step):
                    qs, ps = ids[q[at : at + step]], words[part][p[at : at + step]]
                    hit = _one_edit(text[qs], self.text[ps])
                    if hit.any():
                        yield qs[hit], ps[hit]


# distribution


def _encoded(words: list[str]) -> list[bytes]:
    return [w.encode("latin-1") for w in words]


def routing_trees(words: DataFrame, region: int = REGION) -> dict[int, tuple[KdTree, np.ndarray]]:
    """A k-d tree per length that has more words than one region holds, with the letters that it counts.

    Made from SAMPLE words per region, chosen by hash: at most SAMPLE x (REGIONS + 1) x 2 words on average reach the
    driver whatever the table's size. Every tree is right for all words; the sample only balances the regions.
    """
    sizes = words.groupBy(F.length("word").alias("len")).agg(F.count(F.lit(1)).alias("c"))
    whole = words.count()
    hold = F.least(F.lit(max(region, whole // REGIONS)), F.greatest(F.lit(1), F.lit(REGION_CHARS) / F.col("len"))).cast("long")
    large = sizes.withColumn("hold", hold).where("c > hold")
    rate = F.least(F.lit(1.0), F.lit(float(SAMPLE)) / F.col("hold"))
    drawn = F.pmod(F.xxhash64("word", F.lit(11)), F.lit(1 << 30)) < F.col("rate") * (1 << 30)
    sample = words.join(F.broadcast(large.select("len", rate.alias("rate"))), F.length("word") == F.col("len")).where(drawn).select("word").collect()
    by_length: dict[int, list[str]] = {}
    for r in sorted(sample):
        by_length.setdefault(len(r["word"]), []).append(r["word"])
    trees = {}
    for n, some in by_length.items():
        _, counts, letters = letter_counts(_encoded(some))
        trees[n] = (KdTree(counts, SAMPLE), letters)
    return trees


def _by_length(words: list[str]) -> dict[int, np.ndarray]:
    lengths = np.array([len(w) for w in words], np.int64)
    return {int(n): np.flatnonzero(lengths == n) for n in np.unique(lengths)}


def _place(trees):
    def run(batches):
        for batch in batches:
            words = batch.column("word").to_pylist()
            region = np.zeros(len(words), np.int64)
            for n, ids in _by_length(words).items():
                if n in trees:
                    tree, letters = trees[n]
                    region[ids] = tree.place(letter_counts(_encoded([words[i] for i in ids]), letters)[1])
            yield pa.RecordBatch.from_pydict(
                {"word": batch.column("word"), "n": batch.column("n"), "len": pa.array([len(w) for w in words], pa.int32()), "region": pa.array(region, pa.int32())}
            )

    return run


def _route(trees):
    """Each word as a point of its region, and as a query of every region its letter counts may reach (home: its own)."""

    def run(batches):
        for batch in batches:
            words, home = batch.column("word").to_pylist(), batch.column("region").to_numpy()
            rows, lens, regions, kinds = [], [], [], []

            def put(ids, length, region, kind):
                rows.append(ids)  # noqa: B023 - used within this batch
                lens.append(np.full(len(ids), length))  # noqa: B023
                regions.append(np.full(len(ids), region) if np.isscalar(region) else region)  # noqa: B023
                kinds.append(np.full(len(ids), kind))  # noqa: B023

            for n, ids in _by_length(words).items():
                put(ids, n, home[ids], 0)
                for length, down in ((n, 1), (n + 1, 0)):
                    if length not in trees:
                        put(ids, length, 0, 1)
                        continue
                    tree, letters = trees[length]
                    counts = letter_counts(_encoded([words[i] for i in ids]), letters)[1]
                    for leaf, some in tree.search(counts, 1, down):
                        some = ids[some]
                        # a pair of one length is found from the smaller region
                        some = some[home[some] <= leaf] if length == n else some
                        put(some, length, leaf, 1)
            at = pa.array(np.concatenate(rows)) if rows else pa.array([], pa.int64())
            made = {c: pa.array(np.concatenate(v).astype(np.int32) if v else [], pa.int32()) for c, v in (("len", lens), ("region", regions), ("kind", kinds))}
            yield pa.RecordBatch.from_pydict(made | {c: batch.column(b).take(at) for c, b in (("home", "region"), ("word", "word"), ("n", "n"))})

    return run


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of a partition whose rows come block by block, points before queries."""
    block, points, queries, tree, home = None, [], [], None, 0

    def answer():
        nonlocal tree, queries
        if tree is None:
            tree = Region([w for w, _ in points])
        for n in {len(w) for w, _, _ in queries}:
            some = [q for q in queries if len(q[0]) == n]
            for qs, ps in tree.near([w for w, _, _ in some]):
                pairs = [(*some[q], *points[p]) for q, p in zip(qs.tolist(), ps.tolist(), strict=True)]
                # within a region of one length each pair is met twice
                pairs = [(a, na, b, nb) for a, na, at, b, nb in pairs if len(a) != len(b) or at != home or a < b]
                if pairs:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*pairs, strict=True), (pa.string(), pa.int64()) * 2, strict=True)],
                        ["a", "a_n", "b", "b_n"],
                    )
        queries = []

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("len", "region", "slice", "kind", "word", "n", "home")]
        for length, region, piece, kind, word, n, at in zip(*columns, strict=True):
            if (length, region, piece) != block:
                if points and queries:
                    yield from answer()
                block, points, queries, tree, home = (length, region, piece), [], [], None, region
            if kind == 0:
                points.append((word, n))
            elif points:
                queries.append((word, n, at))
                if len(queries) >= QUERIES:
                    yield from answer()
    if points and queries:
        yield from answer()


def near_pairs(words: DataFrame, region: int = REGION) -> DataFrame:
    """``a, a_n, b, b_n``: every pair of ``word, n`` rows one edit apart, once.

    Words of a length that has more than ``region`` of them are dealt to the leaves of that length's routing tree. A region
    that still holds twice as many (many words of the same letters) is sliced by hash, and its
    queries go to each slice, so no task holds more than a slice at once.
    """
    spark = words.sparkSession
    prepare_python(spark)
    words = materialise(words.select("word", "n"), "spelling-words")
    trees = routing_trees(words, region)
    placed = materialise(words.mapInArrow(_place(trees), "word string, n long, len int, region int"), "spelling-regions")
    hold = F.least(F.lit(2 * max(region, placed.count() // REGIONS)), F.greatest(F.lit(1), F.lit(2 * REGION_CHARS) / F.col("len"))).cast("long")
    full = placed.groupBy("len", "region").agg(F.count(F.lit(1)).alias("c")).withColumn("hold", hold).where("c > hold")
    # fewer than REGIONS rows of ordinary words: each stands for over 1 / REGIONS of all words or REGION_CHARS letters
    full = F.broadcast(full.select("len", "region", F.ceil(F.col("c") / F.col("hold")).cast("int").alias("slices")))
    routed = placed.mapInArrow(_route(trees), "len int, region int, kind int, home int, word string, n long")
    routed = routed.join(full, ["len", "region"], "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    own = F.pmod(F.xxhash64("word", F.lit(5)), F.col("slices")).cast("int")
    routed = routed.withColumn("slice", F.explode(F.when(F.col("kind") == 0, F.array(own)).otherwise(F.sequence(F.lit(0), F.col("slices") - 1))))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = routed.repartition(n, "len", "region", "slice").sortWithinPartitions("len", "region", "slice", "kind")
    return blocks.mapInArrow(_search, "a string, a_n long, b string, b_n long")


def follow_forms(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: the last word of each chain, by doubling the step each round.

    A form has at least twice the occurrences of its word, so chains are shorter than 64 and seven rounds suffice;
    the loop ends when no pointer moves. A root of very many words is dealt over salts by their number.
    """
    at = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        hot = materialise(hot_keys(at, "root"), "spelling-hot")
        moved = degree_join(at, step, "root", ["word"], hot, "left")
        moved = materialise(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_count: int = MIN_COUNT, region: int = REGION) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    * a word's form is its near word of most occurrences (of equals the smallest), where these are at least twice its own;
    * null and empty texts have no words; an empty table gives an empty result; repeated rows count again;
    * a run of letters of any length is a word like any other; other columns are ignored.
    """
    words = materialise(count_words(docs, id_col, text_col, min_count), "spelling-counts")
    pairs = materialise(near_pairs(words, region), "spelling-pairs")
    links = pairs.select("a", F.col("b").alias("other"), F.col("b_n").alias("m")).unionAll(pairs.select("b", "a", "a_n")).toDF("word", "other", "m")
    best = F.min_by(F.struct("other", "m"), F.struct(-F.col("m"), F.col("other")))
    near = links.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    rows = words.join(near, "word", "left")
    takes = F.col("best.m") >= 2 * F.col("n")
    rows = materialise(
        rows.select(
            "word",
            F.when(takes, F.col("best.other")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(takes, F.col("best.m")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = follow_forms(rows.where("form IS NOT NULL"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
