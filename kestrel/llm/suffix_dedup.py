"""Removal of repeated 100-byte strings by a distributed merge sort of front-coded suffix runs."""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import materialise, prepare_python, stored, with_row_key
from kestrel.llm.suffix_merge import ORDER, PLACE, cut, lcp_from, merge, neighbour_lcp, pack, place, unpack, unplace

WINDOW = 100  # bytes of a repeated string
GRAM = 32  # bytes of an anchor
REACH = WINDOW - GRAM  # an anchor starts up to this far into a window
CHUNK = 1 << 18  # bytes that anchors are computed over at once: arrays that fit a core's cache
RUN_ENTRIES = 1 << 17  # entries of a sorted run
RANGE_ENTRIES = 1 << 16  # entries meant for a merge range
MAX_RANGES = 100_000
SAMPLES_A_RANGE = 4
FEW = 32  # contexts of an anchor that are compared with each other at once
PLACE_BITS = 20  # of a position among them


def _doubled(h: np.ndarray, size: int, to: int) -> np.ndarray:
    """Hashes of ``to`` bytes at each position from those of ``size`` bytes (size < to <= 2 size)."""
    out = h[: len(h) - (to - size)] * np.uint64(0x9E3779B97F4A7C15 + 2 * to)
    out += h[to - size :]
    return out


_BYTE = np.random.default_rng(1).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def anchors(raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of the windows that start in the ranges first..last (inclusive, ascending) of a byte array.

    A window's anchor is its GRAM-byte string of least hash, the leftmost of equals: a choice that depends on the
    window's bytes alone. Returns hash, position, and first and last window start of each anchor.
    """
    h, size = _BYTE[raw], 1
    while size < GRAM:
        to = min(2 * size, GRAM)
        h, size = _doubled(h, size, to), to
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    low = (h >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size < REACH + 1:
        to = min(2 * size, REACH + 1)
        low, size = np.minimum(low[: len(low) - (to - size)], low[to - size :]), to
    inside = np.zeros(len(raw) + 1, np.int8)
    np.add.at(inside, first, 1)
    np.add.at(inside, last + 1, -1)
    start = np.flatnonzero(np.cumsum(inside[: len(low)]))
    at = (low[start] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    if not len(start):
        return h[:0], at, start, start
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)])
    return h[at[new]], at[new], start[new], start[np.r_[new[1:], len(start)] - 1]


def _pieces(rows: Iterator[tuple[int, bytes]]) -> Iterator[list[tuple[int, int, bytes]]]:
    """(row, offset, bytes) in lists of about CHUNK bytes; parts of a long text overlap by WINDOW - 1."""
    part, size = [], 0
    for row, raw in rows:
        for at in range(0, max(len(raw) - WINDOW + 1, 0), CHUNK):
            piece = raw[at : at + CHUNK + WINDOW - 1]
            part.append((row, at, piece))
            size += len(piece)
            if size >= CHUNK:
                yield part
                part, size = [], 0
    if part:
        yield part


def _anchor_rows(hash_only: bool):
    def run(batches):
        def rows():
            for b in batches:
                for row, t in zip(b.column("_row").to_pylist(), b.column("t").to_pylist(), strict=True):
                    yield row, (t or "").encode()

        for part in _pieces(rows()):
            size = np.array([len(p) for _, _, p in part])
            base = np.cumsum(size) - size
            h, at, first, last = anchors(np.frombuffer(b"".join(p for _, _, p in part), np.uint8), base, base + size - WINDOW)
            if hash_only:
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])
                continue
            which = np.searchsorted(base, at, "right") - 1
            pos = at - base[which] + np.array([o for _, o, _ in part])[which]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h.view(np.int64)),
                    pa.array(np.array([r for r, _, _ in part])[which]),
                    # position, and reach back to the first and to the last window, in one number
                    pa.array((pos << 16) + ((at - first) << 8) + (at - last)),
                ],
                names=["h", "_row", "a"],
            )

    return run


def _pack_spans(spans: np.ndarray) -> bytes:
    """Rows of (row, start, end) by row and start, as differences, compressed."""
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    columns = np.column_stack([np.diff(spans[:, 0], prepend=0), spans[:, 1], spans[:, 2] - spans[:, 1]])
    return b"\0" + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(columns.T).tobytes())


def _unpack_spans(blob: bytes) -> np.ndarray:
    columns = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), np.int64).reshape(3, -1)
    return np.column_stack([np.cumsum(columns[0]), columns[1], columns[1] + columns[2]])


class _Runs:
    """Collects entries of a task, and turns every RUN_ENTRIES of them into a sorted run cut by ``splitters``.

    Of equal strings in a run only the earliest goes on; the others are repeated already.
    """

    def __init__(self, splitters: list[bytes], covers):
        self.splitters, self.covers, self.entries = splitters, covers, []

    def add(self, entry: bytes) -> Iterator[pa.RecordBatch]:
        self.entries.append(entry)
        if len(self.entries) >= RUN_ENTRIES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        entries, self.entries = sorted(self.entries), []
        if not entries:
            return
        size = np.fromiter(map(len, entries), np.int64, len(entries))
        lcp = neighbour_lcp(entries)
        again = np.r_[False, (size[1:] == size[:-1]) & (lcp[1:] >= size[1:] - ORDER)]
        spans = [self.covers(entries[i]) for i in np.flatnonzero(again).tolist()]
        # what an entry shares with the last one that stays is what it shares with that one's equals
        stay = np.flatnonzero(~again)
        lcp, entries = lcp[stay], [entries[i] for i in stay.tolist()]
        rows = [(target, pack(entries[a:b], lcp[a:b])) for target, a, b in cut(entries, self.splitters)]
        # known spans travel with the runs, dealt evenly; they are no part of any range
        for part, (target, _) in zip(np.array_split(np.array(spans, np.int64).reshape(-1, 3), len(rows)), list(rows), strict=True):
            if len(part):
                rows.append((target, _pack_spans(part)))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["target", "blob"])


def context_entry(raw: bytes, doc_id: int | None, row: int, pos: int, far: int, near: int) -> bytes:
    """Suffix from an anchor to the end of its last window, then the bytes before it backwards, then both reaches."""
    return raw[pos : pos - near + WINDOW] + raw[pos - far : pos][::-1] + bytes((far, near)) + place(doc_id, row, pos)


def _context_span(entry: bytes) -> tuple[int, int, int]:
    _, _, row, pos = PLACE.unpack_from(entry, len(entry) - ORDER)
    return row, pos - entry[-ORDER - 2], pos - entry[-ORDER - 1] + WINDOW


def _window_span(entry: bytes) -> tuple[int, int, int]:
    _, _, row, pos = PLACE.unpack_from(entry, len(entry) - ORDER)
    return row, pos, pos + WINDOW


def _context_entries(batches) -> Iterator[bytes]:
    """Entries of the listed anchors of each text."""
    for b in batches:
        for row, doc_id, text, found in zip(*(b.column(c) for c in ("_row", "doc_id", "t", "found")), strict=True):
            raw, row, doc_id = text.as_py().encode(), row.as_py(), doc_id.as_py()
            for a in found.values.to_pylist():
                yield context_entry(raw, doc_id, row, a >> 16, a >> 8 & 255, a & 255)


def _context_runs(splitters: list[bytes]):
    def run(batches):
        runs = _Runs(splitters, _context_span)
        for e in _context_entries(batches):
            yield from runs.add(e)
        yield from runs.flush()

    return run


def _context_samples(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_context_entries([b]), pa.binary())], names=["e"])


def _window_entries(ctx: bytes, doc_id: int | None, row: int, first: int) -> Iterator[bytes]:
    for i in range(len(ctx) - WINDOW + 1):
        yield ctx[i : i + WINDOW] + place(doc_id, row, first + i)


def _window_runs(splitters: list[bytes]):
    def run(batches):
        runs = _Runs(splitters, _window_span)
        for b in batches:
            for row, doc_id, first, ctx in zip(*(b.column(c).to_pylist() for c in ("_row", "doc_id", "start", "ctx")), strict=True):
                for e in _window_entries(ctx, doc_id, row, first):
                    yield from runs.add(e)
        yield from runs.flush()

    return run


def _open_windows(group: list[tuple[bytes, int]], whole: bool, head: bool, tail: bool) -> Iterator[tuple[bytes, int, int]]:
    """Windows of an anchor's distinct contexts that can be equal to a window of another: (entry, far, near).

    ``group``: (entry, prefix shared with the context before) in sorted order. A window that starts ``o`` bytes before the anchor
    needs another context with ``o`` equal bytes to the left and WINDOW - o to the right. The
    longest right match is a sorted neighbour's; the longest left match is a neighbour's in the order of the reversed left parts,
    known if the group is ``whole``. Where a range cuts the group, what lies beyond counts as a full match.
    """
    n = len(group)
    if n == 1 and whole:
        return
    right = [k for _, k in group] + [0]
    right[0] = WINDOW if head else 0
    right[n] = WINDOW if tail else 0
    left = [REACH] * n
    if whole:
        backwards = [e[WINDOW - e[-ORDER - 1] : -ORDER - 2] for e, _ in group]
        order = sorted(range(n), key=backwards.__getitem__)
        lcp = neighbour_lcp([backwards[i] for i in order]).tolist() + [0]
        for r, i in enumerate(order):
            left[i] = max(lcp[r], lcp[r + 1])
    for i, (e, _) in enumerate(group):
        far, near = e[-ORDER - 2], e[-ORDER - 1]
        low, high = max(near, WINDOW - max(right[i], right[i + 1])), min(far, left[i])
        if low <= high:
            yield e, high, low


def _paired_spans(group: list[tuple[bytes, int]]) -> Iterator[tuple[int, int, int]]:
    """Repeated spans among a few distinct contexts of one anchor, all of which are here.

    What two of them share to the right is the least prefix length between them in sorted order, known from the merge;
    only the left parts are compared. The later one's windows within both matches are repeated.
    """
    heads = []
    for e, _ in group:
        far, near = e[-ORDER - 2], e[-ORDER - 1]
        heads.append((e[-ORDER:], e[WINDOW - near : -ORDER - 2], far, near))
    for i in range(len(group) - 1):
        shared = WINDOW
        for j in range(i + 1, len(group)):
            shared = min(shared, group[j][1])
            # beyond the shorter suffix other bytes follow
            right = min(shared, WINDOW - heads[i][3], WINDOW - heads[j][3])
            later, other = (heads[i], heads[j]) if heads[i][0] > heads[j][0] else (heads[j], heads[i])
            low = max(later[3], WINDOW - right)
            high = min(later[2], len(other[1]))
            if low <= high:
                high = min(later[2], lcp_from(later[1], other[1], 0))
                if low <= high:
                    _, _, row, pos = PLACE.unpack(later[0])
                    yield row, pos - high, pos - low + WINDOW


def _merge_ranges(kind: str):
    """Merge the runs of each range; yields spans that are repeated and, for contexts, windows left to compare."""

    covers = _context_span if kind == "contexts" else _window_span

    def solve(blobs: list[bytes]):
        known = [_unpack_spans(b) for b in blobs if b[:1] == b"\0"]
        if known:
            yield batch(np.concatenate(known), [])
        spans, ctxs = [], []
        size, first_group, group = -1, True, []

        def close(end: bool):
            nonlocal group, first_group
            whole = not (first_group or end)
            if whole and len(group) <= FEW:
                if len(group) > 1:
                    spans.extend(_paired_spans(group))
            elif group:
                for e, far, near in _open_windows(group, whole, first_group, end):
                    doc_id, row, pos = unplace(e)
                    right = WINDOW - e[-ORDER - 1]
                    ctxs.append((row, doc_id, pos - far, e[right : right + far][::-1] + e[: WINDOW - near]))
            if group:
                first_group = False
            group = []

        for k, e in merge([unpack(b) for b in blobs if b[:1] != b"\0"]):
            if len(e) == size and k >= size - ORDER:
                spans.append(covers(e))
                if len(spans) >= 1 << 16:
                    yield batch(spans, ctxs)
                    spans, ctxs = [], []
            elif kind == "contexts":
                if k < GRAM:
                    close(False)
                group.append((e, k))
            size = len(e)
        close(True)
        yield batch(spans, ctxs)

    def batch(spans, ctxs):
        a = np.array(spans, np.int64).reshape(-1, 3)
        row, doc_id, start, ctx = zip(*ctxs, strict=True) if ctxs else ((), (), (), ())
        none = [None] * len(a)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([a[:, 0], np.array(row, np.int64)])),
                pa.array(none + list(doc_id), pa.int64()),
                pa.array(np.concatenate([a[:, 1], np.array(start, np.int64)])),
                pa.array(np.concatenate([a[:, 2], np.zeros(len(row), np.int64)])),
                pa.array(none + list(ctx), pa.binary()),
            ],
            names=["_row", "doc_id", "start", "end", "ctx"],
        )

    def run(batches):
        target, blobs = None, []
        for b in batches:
            for t, blob in zip(b.column("target").to_pylist(), b.column("blob").to_pylist(), strict=True):
                if t != target and blobs:
                    yield from solve(blobs)
                    blobs = []
                target = t
                blobs.append(blob)
        if blobs:
            yield from solve(blobs)

    return run


def _merged(runs: DataFrame, ranges: int, kind: str, name: str) -> DataFrame:
    dealt = runs.repartition(max(ranges, 1), "target").sortWithinPartitions("target")
    return materialise(dealt.mapInArrow(_merge_ranges(kind), "_row long, doc_id long, start long, end long, ctx binary"), name)


def _splitters(samples: list[bytes], ranges: int) -> list[bytes]:
    """ranges - 1 strings that cut the sorted samples evenly; places are left out, so equal strings stay together."""
    samples = sorted(s[:-ORDER] for s in samples)
    return sorted({samples[len(samples) * r // ranges] for r in range(1, ranges)}) if samples else []


def _release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of finished steps: its cleaner acts when unused handles are collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``_row, start, end``: byte ranges (overlapping) of texts that lie in a string that also starts earlier.

    ``docs``: ``_row, doc_id, t``. Steps:

    1. Every window's anchor is found; anchors whose hash occurs once in the corpus have no equal window and leave.
    2. The suffixes at the other anchors, to the end of their last window and extended backwards over their first, are sorted in each
       task to runs of distinct strings, cut into ranges by sampled splitters, exchanged front-coded, and
       merged by loser trees. All windows of an equal string are repeated, but for the first in document order.
    3. Among the distinct strings of one anchor, up to FEW are compared by the prefixes known from the merge and
       their left parts. Where there are more, or a range cuts them, these prefixes leave the windows that can still be equal;
       they go through the same merge sort as strings of 100 bytes.
    """
    found = _repeated_anchors(docs)
    _release(docs.sparkSession)
    contexts = _merge_contexts(docs, found)
    _release(docs.sparkSession)
    windows = _merge_windows(contexts.where(F.col("ctx").isNotNull()).select("_row", "doc_id", "start", "ctx"))
    _release(docs.sparkSession)
    return contexts.where(F.col("ctx").isNull()).select("_row", "start", "end").union(windows.select("_row", "start", "end"))


def _repeated_anchors(docs: DataFrame) -> DataFrame:
    """``_row, a``: the anchors whose hash occurs more than once (``a``: position and both reaches)."""
    rows = docs.select("_row", "t")
    counts = rows.mapInArrow(_anchor_rows(True), "h long").groupBy("h").agg(F.count(F.lit(1)).alias("c"))
    again = materialise(counts.where("c > 1").select("h"), "suffix-again")
    del counts
    _release(docs.sparkSession)
    found = rows.mapInArrow(_anchor_rows(False), "h long, _row long, a long")
    return materialise(found.join(again, "h", "left_semi").drop("h"), "suffix-anchors")


def _merge_contexts(docs: DataFrame, found: DataFrame) -> DataFrame:
    n = found.count()
    ranges = max(1, min(MAX_RANGES, -(-n // RANGE_ENTRIES)))
    texts = docs.select("_row", "doc_id", "t")
    # a bounded sample of suffixes, from which the ranges are cut
    rare = found.where(F.pmod(F.xxhash64("_row", "a"), F.lit(max(1, n // (SAMPLES_A_RANGE * ranges)))) == 0)
    rare = rare.limit(2 * SAMPLES_A_RANGE * MAX_RANGES).groupBy("_row").agg(F.collect_list("a").alias("found"))
    samples = texts.join(F.broadcast(rare), "_row").mapInArrow(_context_samples, "e binary").collect()
    splitters = _splitters([bytes(r["e"]) for r in samples], ranges)
    lists = found.groupBy("_row").agg(F.collect_list("a").alias("found"))
    runs = texts.join(lists, "_row").mapInArrow(_context_runs(splitters), "target int, blob binary")
    return _merged(runs, ranges, "contexts", "suffix-contexts")


def _merge_windows(left: DataFrame) -> DataFrame:
    size = left.agg(F.sum(F.octet_length("ctx") - (WINDOW - 1)).alias("n"), F.count(F.lit(1)).alias("c")).first()
    n = size["n"] or 0
    ranges = max(1, min(MAX_RANGES, -(-n // RANGE_ENTRIES)))
    some = left.where(F.pmod(F.xxhash64("_row", "start"), F.lit(max(1, size["c"] // (SAMPLES_A_RANGE * ranges)))) == 0)
    some = some.limit(2 * SAMPLES_A_RANGE * MAX_RANGES).select(F.substring("ctx", 1, WINDOW).alias("e")).collect()
    splitters = _splitters([bytes(r["e"]) + bytes(ORDER) for r in some], ranges)
    parts = max(1, min(1 << 14, n // RUN_ENTRIES))
    runs = left.repartition(parts).mapInArrow(_window_runs(splitters), "target int, blob binary")
    return _merged(runs, ranges, "windows", "suffix-windows")


def _remove(batches):
    for b in batches:
        out = []
        for text, spans in zip(b.column("t"), b.column("spans"), strict=True):
            raw, spans = (text.as_py() or "").encode(), spans.values
            removed = runs = 0
            kept, at = hashlib.sha256(), 0
            if spans is not None and len(spans):
                s = np.sort(spans.to_numpy())
                start = s >> 8
                reach = np.maximum.accumulate(start + (s & 255))
                new = np.flatnonzero(np.r_[True, start[1:] > reach[:-1]])
                for start, end in zip(start[new].tolist(), reach[np.r_[new[1:], len(s)] - 1].tolist(), strict=True):
                    kept.update(raw[at:start])
                    removed, runs, at = removed + end - start, runs + 1, end
            kept.update(raw[at:])
            out.append((len(raw), removed, runs, kept.hexdigest()))
        cols = list(zip(*out, strict=True)) if out else [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [b.column("_row"), b.column("doc_id"), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]],
            names=["_row", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_row, doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs``.

    Each byte that lies in a 100-byte string which also starts earlier (in a row of smaller id, or further left in the same text) is
    removed; strings are judged on the input. Strings do not cross texts.

    Null text counts as empty; texts under 100 bytes keep everything; a null id comes after all others; rows of
    equal id are ordered by their place in the table; an empty table gives an empty result; other columns are ignored.
    """
    prepare_python(docs.sparkSession)
    rows = with_row_key(stored(docs), "_row", doc_id=F.col(id_col).cast("long"), t=F.col(text_col))
    # a span is at most WINDOW + REACH bytes long: start and length in one number
    span = F.shiftleft("start", 8) + (F.col("end") - F.col("start"))
    spans = repeated_spans(rows).groupBy("_row").agg(F.collect_list(span).alias("spans"))
    joined = rows.join(spans, "_row", "left").select("_row", "doc_id", "t", "spans")
    return joined.mapInArrow(_remove, "_row long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
