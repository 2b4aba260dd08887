"""Sorted runs of byte strings: front coding, splitting into ranges, and an LCP-aware loser tree.

An entry is a string followed by ORDER bytes that say where it stands; entries sort by string, then by place.
"""

from __future__ import annotations

import struct
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import zstandard

PLACE = struct.Struct(">BQQI")  # id missing, id, row, position: sorts as document order, then start
ORDER = PLACE.size
SIGN = 1 << 63


def place(doc_id: int | None, row: int, pos: int) -> bytes:
    return PLACE.pack(doc_id is None, 0 if doc_id is None else doc_id + SIGN, row, pos)


def unplace(entry: bytes) -> tuple[int | None, int, int]:
    """(doc_id, row, position) of an entry."""
    missing, doc_id, row, pos = PLACE.unpack_from(entry, len(entry) - ORDER)
    return (None if missing else doc_id - SIGN), row, pos


def neighbour_lcp(entries: list[bytes]) -> np.ndarray:
    """Length of the prefix that each entry shares with the one before it."""
    sizes = np.fromiter(map(len, entries), np.int64, len(entries))
    out = np.zeros(len(entries), np.int64)
    for at in range(0, len(entries) - 1, 1 << 16):
        part = entries[at : at + (1 << 16) + 1]
        size = sizes[at : at + len(part)]
        width = max(int(size.max()), 1)
        rows = np.frombuffer(b"".join(e.ljust(width, b"\0") for e in part), np.uint8).reshape(-1, width)
        same = rows[1:] == rows[:-1]
        first = np.where(same.all(axis=1), width, same.argmin(axis=1))
        out[at + 1 : at + len(part)] = np.minimum(first, np.minimum(size[1:], size[:-1]))
    return out


def pack(entries: list[bytes], lcp: np.ndarray | None = None) -> bytes:
    """Front-coded run: shared prefix lengths, rest lengths, rests; compressed. ``lcp``: known prefix lengths."""
    lcp = neighbour_lcp(entries) if lcp is None else np.r_[0, lcp[1:]]
    rests = [e[k:] for e, k in zip(entries, lcp.tolist(), strict=True)]
    lengths = np.fromiter(map(len, rests), np.uint8, len(rests))
    body = struct.pack("<I", len(entries)) + lcp.astype(np.uint8).tobytes() + lengths.tobytes() + b"".join(rests)
    return zstandard.ZstdCompressor(level=1).compress(body)


def unpack(blob: bytes) -> Iterator[tuple[int, bytes]]:
    """(shared prefix length, entry) of a packed run, in order."""
    body = zstandard.ZstdDecompressor().decompress(blob)
    n = struct.unpack_from("<I", body)[0]
    at, last = 4 + 2 * n, b""
    for k, size in zip(body[4 : 4 + n], body[4 + n : 4 + 2 * n], strict=True):
        last = last[:k] + body[at : at + size]
        at += size
        yield k, last


def cut(entries: list[bytes], splitters: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """(range number, start, end) of the parts of a sorted run; range r ends before splitters[r]."""
    at = 0
    while at < len(entries):
        r = bisect_right(splitters, entries[at])
        end = bisect_left(entries, splitters[r], at) if r < len(splitters) else len(entries)
        yield r, at, end
        at = end


def lcp_from(a: bytes, b: bytes, k: int) -> int:
    """Length of the common prefix of two strings known to share their first k bytes."""
    n = min(len(a), len(b))
    if a[k:n] == b[k:n]:
        return n
    step = 8
    while a[k : k + step] == b[k : k + step]:
        k += step
        step *= 2
    while step > 1:
        step //= 2
        if a[k : k + step] == b[k : k + step]:
            k += step
    return k


def merge(runs: Iterable[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, bytes]]:
    """Merge sorted runs; yields (prefix shared with the entry yielded before, entry).

    Loser tree. Each waiting entry keeps the length of the prefix it shares with the winner
    that passed it, which is the last entry yielded. Of two entries the one that shares more with that
    winner is the smaller; only at equal lengths are bytes compared, and only those beyond: no
    known prefix is read again.
    """
    streams = [iter(r) for r in runs]
    k = 1
    while k < len(streams):
        k *= 2
    end = (-1, b"")  # a stream that has ended shares less than nothing: it loses to all
    # losers: known prefix, entry and stream of the head that waits at each inner node
    lens, heads, whose = [-1] * k, [b""] * k, [k] * k
    first = [next(s, end) for s in streams] + [end] * (k - len(streams))
    # first entries have no predecessor: they share nothing with it
    won = [None] * k + [(min(n, 0), e, i) for i, (n, e) in enumerate(first)]
    for node in range(k - 1, 0, -1):
        a, b = won[2 * node], won[2 * node + 1]
        n = a[0]
        if n == b[0] == 0:
            n = lcp_from(a[1], b[1], 0)
            if a[1][n : n + 1] > b[1][n : n + 1]:
                a, b = b, a
            b = (n, b[1], b[2])
        elif n < b[0]:
            a, b = b, a
        won[node] = a
        lens[node], heads[node], whose[node] = b
    n, e, i = won[1]
    while n >= 0:
        yield n, e
        n, e = next(streams[i], end)
        node = (k + i) >> 1
        while node:
            m = lens[node]
            if n == m:
                if n >= 0:
                    f = heads[node]
                    c = lcp_from(e, f, n)
                    if e[c : c + 1] <= f[c : c + 1]:
                        lens[node] = c
                    else:
                        lens[node], heads[node], whose[node], e, i = c, e, i, f, whose[node]
            elif n < m:
                lens[node], heads[node], whose[node], n, e, i = n, e, i, m, heads[node], whose[node]
            node >>= 1
