"""Byte-level BPE by recursive DuckDB queries inside each partition."""

from __future__ import annotations

import base64
import hashlib
import re as stdlib_re
from collections.abc import Iterable, Iterator
from itertools import islice

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import prepare_python

PIECE = 1 << 20  # characters of a text split into words at once
ROUNDS = 48  # merges a word per recursive query; what is unfinished goes on in the next
QUERY_BYTES = 1 << 18  # bytes of new words per recursive query
LONG_WORD = 96  # characters from which a word is put together from pieces
GROUP = 1 << 21  # characters whose new words are encoded by one call
CHUNK, LAP = 192, 96  # bytes of a piece of a long word, and of it shared with the next
CHUNKS = 256  # pieces per recursive query
CACHED_WORDS = 900_000  # distinct words whose ids a worker keeps
MEMORY = "300MB"

# Contract each word's leftmost pair of minimum rank until no pair is in the merge table. A row is a token at a
# position of a word, with the token after it; words without a mergeable pair leave the recursion.
ONE_PAIR = """
WITH RECURSIVE step(word, round, pos, tok, nxt) AS (
    SELECT word, 0, pos, tok, lead(tok) OVER (PARTITION BY word ORDER BY pos) FROM start
  UNION ALL
    (WITH hits AS (
       SELECT word, min((merged::BIGINT << 32) | pos) AS hit
       FROM step JOIN merges ON pair = tok::BIGINT * 65536 + nxt
       WHERE round < {rounds} GROUP BY word),
     best AS (SELECT word, (hit & 4294967295)::INTEGER AS place, (hit >> 32)::INTEGER AS merged FROM hits),
     joint AS (SELECT best.*, nxt AS beyond FROM best JOIN step ON step.word = best.word AND step.pos = place + 1)
     SELECT word, round + 1, CASE WHEN pos > place THEN pos - 1 ELSE pos END, CASE WHEN pos = place THEN merged ELSE tok END,
            CASE WHEN pos = place THEN beyond WHEN pos = place - 1 THEN merged ELSE nxt END
     FROM step JOIN joint USING (word)
     WHERE pos <> place + 1))
SELECT word, round, pos, tok FROM step JOIN (SELECT word, max(round) AS round FROM step GROUP BY word) USING (word, round)
"""

# The same for long words that cannot be put together from pieces: pairs of equal minimum rank that do not overlap are contracted
# in one round where the merge table proves that the order cannot matter (column alike).
ALL_PAIRS = """
WITH RECURSIVE step(word, round, pos, tok) AS (
    SELECT word, 0, pos, tok FROM start
  UNION ALL
    SELECT word, round + 1, (row_number() OVER (PARTITION BY word ORDER BY pos) - 1)::INTEGER, CASE WHEN joins THEN merged ELSE tok END
    FROM (
      SELECT *, coalesce(lag(joins) OVER (PARTITION BY word ORDER BY pos), false) AS gone
      FROM (
        SELECT *, coalesce(hit AND (pos - min(pos) OVER (PARTITION BY word, hit, island)) % 2 = 0 AND (alike OR pos = first_hit), false) AS joins
        FROM (
          SELECT *, pos - row_number() OVER (PARTITION BY word, hit ORDER BY pos) AS island, min(CASE WHEN hit THEN pos END) OVER (PARTITION BY word) AS first_hit
          FROM (
            SELECT word, round, pos, tok, merged, alike, coalesce(merged = min(merged) OVER (PARTITION BY word), false) AS hit, min(merged) OVER (PARTITION BY word) AS best
            FROM (SELECT word, round, pos, tok, tok::BIGINT * 65536 + lead(tok) OVER (PARTITION BY word ORDER BY pos) AS pair FROM step WHERE round < {rounds})
            LEFT JOIN merges USING (pair))
          WHERE best IS NOT NULL)))
    WHERE NOT gone)
SELECT word, round, pos, tok FROM step QUALIFY round = max(round) OVER (PARTITION BY word)
"""

# ids of each word, and the hex of the bytes that they decode to
COLLECT = """
SELECT word, list(tok ORDER BY pos) AS ids, string_agg(hex, '' ORDER BY pos) AS bytes
FROM done JOIN vocab USING (tok) GROUP BY word
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _cuts(text: str) -> Iterator[str]:
    """A text in pieces that end before white space that follows none: no word of the pattern crosses there."""
    at = 0
    while len(text) - at > PIECE:
        m = stdlib_re.compile(r"\S(?=\s)").search(text, at + PIECE)
        if not m:
            break
        yield text[at : m.end()]
        at = m.end()
    yield text[at:]


class Tokenizer:
    """One worker's vocabulary in an in-memory DuckDB database of its own, with the ids of recent words."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        if len(ranks) > 65536:
            raise ValueError("pairs are packed from 16-bit ids")
        self.find = regex.compile(pattern).findall
        self.ranks = ranks
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        self.size[list(ranks.values())] = [len(t) for t in ranks]
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        # tokens that a pair can contract further at a lower rank than their own: order matters
        unsafe = {t for a, b, m in zip(left, right, merged, strict=True) for t in (a, b) if m < t}
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        merges = pa.table(  # noqa: F841 - read by name in SQL
            {
                "pair": pa.array([a * 65536 + b for a, b in zip(left, right, strict=True)], pa.int64()),
                "merged": pa.array(merged, pa.int32()),
                "alike": pa.array([m not in unsafe for m in merged]),
            }
        )
        vocab = pa.table(  # noqa: F841
            {
                "tok": pa.array(ranks.values(), pa.int32()),
                "hex": pa.array([t.hex() for t in ranks]),
            }
        )
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merges")
        self.db.execute("CREATE TABLE vocab AS SELECT * FROM vocab")
        self.ids: dict[str, bytes] = {}
        self.odd: dict[str, bytes] = {}  # decoded bytes of words whose ids do not decode to the word itself

    def _start(self, raw: list[bytes]) -> pa.Table:
        """Token-position rows: the bytes of each word; a word that is itself a token is that token."""
        whole = np.array([self.ranks.get(r, -1) for r in raw], np.int32)
        size = np.where(whole < 0, [len(r) for r in raw], 1)
        tok = self.byte[np.frombuffer(b"".join(r if t < 0 else b"\0" for r, t in zip(raw, whole, strict=True)), np.uint8)]
        ends = np.cumsum(size)
        tok[(ends - 1)[whole >= 0]] = whole[whole >= 0]
        word = np.repeat(np.arange(len(raw), dtype=np.int32), size)
        pos = (np.arange(len(tok)) - np.repeat(ends - size, size)).astype(np.int32)
        return pa.table({"word": word, "pos": pos, "tok": tok})

    def _contract(self, raw: list[bytes], sql: str) -> pa.Table:
        """Rows ``word, pos, tok`` of the contracted words."""
        start = self._start(raw)
        parts = [start.schema.empty_table()]
        while start.num_rows:
            self.db.register("start", start)
            got = self.db.sql(sql.format(rounds=ROUNDS)).to_arrow_table()
            self.db.unregister("start")
            open_ = pa.compute.equal(got["round"], ROUNDS)
            parts.append(got.filter(pa.compute.invert(open_)).select(["word", "pos", "tok"]))
            start = got.filter(open_).select(["word", "pos", "tok"])
        return pa.concat_tables(parts)

    def _keep(self, words: list[str], done: pa.Table) -> None:
        """Remember the ids of ``words``, and what they decode to."""
        self.db.register("done", done)
        out = self.db.sql(COLLECT).to_arrow_table().combine_chunks()
        self.db.unregister("done")
        lists = out["ids"].combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        ends = (lists.offsets.to_numpy() - lists.offsets[0].as_py()) * 4
        packed = lists.flatten().to_numpy().astype("<u4").tobytes()
        for i, lo, hi, hexed in zip(out["word"].to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), out["bytes"].to_pylist(), strict=True):
            word = words[i]
            self.ids[word] = packed[lo:hi]
            raw = bytes.fromhex(hexed)
            if raw != word.encode():
                self.odd[word] = raw

    def _pieces(self, raw: bytes) -> pa.Table | None:
        """A long word put together from overlapping pieces, or None if two neighbours share no token.

        A sequence of tokens is what contraction gives if each two neighbours in it are what contraction of their bytes
        gives: the first contraction across a border would already happen between the two alone. Neighbours in a contracted
        piece are such a pair. So two pieces may be joined after a token that both have at the same place.
        """
        starts = range(0, max(1, len(raw) - LAP), CHUNK - LAP)
        tables = []
        for at in range(0, len(starts), CHUNKS):
            some = starts[at : at + CHUNKS]
            part = self._contract([raw[i : i + CHUNK] for i in some], ONE_PAIR).sort_by([("word", "ascending"), ("pos", "ascending")])
            word, tok = part["word"].to_numpy(), part["tok"].to_numpy()
            cuts = np.searchsorted(word, np.arange(len(some) + 1))
            tables += [tok[lo:hi] for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
        whole: list[np.ndarray] = []
        left = None  # tokens of the piece before, and the place where each ends
        for at, tok in zip(starts, tables, strict=True):
            ends = at + np.cumsum(self.size[tok])
            if left is not None:
                before, before_ends, used = left
                same = np.flatnonzero(np.isin(before_ends * 65536 + before, ends * 65536 + tok))
                same = same[same >= used]
                if not len(same):
                    return None
                # the middle of what they share is far from both pieces' ends
                last = int(same[len(same) // 2])
                whole.append(before[used : last + 1])
                first = int(np.searchsorted(ends, before_ends[last], "right"))
            else:
                first = 0
            left = (tok, ends, first)
        whole.append(left[0][left[2] :])
        found = np.concatenate(whole)
        return pa.table({"word": np.zeros(len(found), np.int32), "pos": np.arange(len(found), dtype=np.int32), "tok": found.astype(np.int32)})

    def learn(self, words: set[str]) -> None:
        """Make sure that ``ids`` holds these distinct words."""
        part: list[str] = []
        size = 0
        for w in words.difference(self.ids):
            if len(w) >= LONG_WORD:
                raw = w.encode()
                self._keep([w], (self._pieces(raw) if raw not in self.ranks else None) or self._contract([raw], ALL_PAIRS))
                continue
            part.append(w)
            size += len(w)
            if size >= QUERY_BYTES:
                self._keep(part, self._contract([x.encode() for x in part], ONE_PAIR))
                part, size = [], 0
        if part:
            self._keep(part, self._contract([x.encode() for x in part], ONE_PAIR))

    def decoded(self, words: list[str]) -> bytes:
        """The bytes that the ids of these words decode to."""
        if self.odd:
            words = [self.odd.get(w, w.encode()) for w in words]
            return b"".join(words)
        return "".join(words).encode()

    def forget(self) -> None:
        """Keep the first half of a full cache: frequent words are met first."""
        if len(self.ids) > CACHED_WORDS:
            self.ids = dict(islice(self.ids.items(), CACHED_WORDS // 2))
            self.odd = {w: raw for w, raw in self.odd.items() if w in self.ids}


_TOKENIZERS: dict[tuple[str, str], Tokenizer] = {}


def tokenizer(path: str, pattern: str) -> Tokenizer:
    """The worker's tokenizer: built once in a Python process and kept for its next tasks."""
    key = (path, pattern)
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = Tokenizer(path, pattern)
    return _TOKENIZERS[key]


def _groups(texts: list[str]) -> Iterator[list[tuple[int, str]]]:
    """(document, piece) in lists of about GROUP characters, each learned in one go."""
    group, size = [], 0
    for d, text in enumerate(texts):
        for piece in _cuts(text):
            group.append((d, piece))
            size += len(piece)
            if size >= GROUP:
                yield group
                group, size = [], 0
    if group:
        yield group


def _words(t: Tokenizer, texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """(document, words of one of its pieces), in order, with the words' ids known to ``t``."""
    for group in _groups(texts):
        found = [(d, t.find(piece)) for d, piece in group]
        t.forget()
        t.learn(set().union(*(words for _, words in found)))
        yield from found


def _keys(batch: pa.RecordBatch) -> dict:
    return {"_row": batch.column("_row"), "doc_id": batch.column("doc_id")}


def _encode(path: str, pattern: str):
    def run(batches):
        for batch in batches:
            t = tokenizer(path, pattern)
            ids = [bytearray() for _ in range(batch.num_rows)]
            for d, words in _words(t, [x.as_py() or "" for x in batch.column("t")]):
                ids[d] += b"".join(map(t.ids.__getitem__, words))
            yield pa.RecordBatch.from_pydict(_keys(batch) | {"ids": pa.array(map(bytes, ids), pa.binary())})

    return run


def _round_trip(path: str, pattern: str):
    def run(batches):
        for batch in batches:
            t = tokenizer(path, pattern)
            n = [0] * batch.num_rows
            ids, raw = ([hashlib.sha256() for _ in n] for _ in range(2))
            for d, words in _words(t, [x.as_py() or "" for x in batch.column("t")]):
                part = b"".join(map(t.ids.__getitem__, words))
                n[d] += len(part) // 4
                ids[d].update(part)
                raw[d].update(t.decoded(words))
            yield pa.RecordBatch.from_pydict(
                _keys(batch)
                | {"n_tokens": pa.array(n, pa.int64())}
                | {"ids_sha256": pa.array([x.hexdigest() for x in ids]), "decoded_sha256": pa.array([x.hexdigest() for x in raw])}
            )

    return run


def _decode(path: str, pattern: str):
    def run(batches):
        for batch in batches:
            db = tokenizer(path, pattern).db
            out = []
            for x in batch.column("ids"):
                ids = np.frombuffer(x.as_py() or b"", "<u4").astype(np.int32)
                raw = bytearray()
                for i in range(0, len(ids), PIECE):
                    part = ids[i : i + PIECE]
                    db.register("seq", pa.table({"pos": np.arange(len(part), dtype=np.int32), "tok": part}))
                    got = db.execute("SELECT string_agg(hex, '' ORDER BY pos), count(*) FROM seq JOIN vocab USING (tok)").fetchall()[0]
                    db.unregister("seq")
                    if got[1] != len(part):
                        raise ValueError("an id is not in the vocabulary")
                    raw += bytes.fromhex(got[0])
                out.append(bytes(raw))
            yield pa.RecordBatch.from_pydict(_keys(batch) | {"raw": pa.array(out, pa.binary())})

    return run


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    prepare_python(docs.sparkSession)
    return docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_row, doc_id, ids``: token ids of each whole text as little-endian unsigned 32-bit integers.

    Every match of ``pattern`` is a word and is encoded by itself: its UTF-8 bytes are tokens at
    positions, and a recursive query joins neighbours to the merge table and contracts each word's leftmost pair
    of minimum rank until none is left. A task encodes the distinct words of a group of texts at
    once. Null text is empty and has no ids; repeated rows are encoded like any other; an empty table gives an empty
    result; other columns are ignored. Characters that no match of the pattern covers would be lost; the public pattern covers all.
    """
    kind = dict(docs.dtypes)[id_col]
    return _rows(docs, id_col, text_col).mapInArrow(_encode(path, pattern), f"_row long, doc_id {kind}, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``_row, doc_id, raw``: the bytes of each sequence of ``encode``, by ordered aggregation over the vocabulary.

    A null sequence is empty; an id outside the vocabulary raises.
    """
    kind = dict(encoded.dtypes)["doc_id"]
    return encoded.select("_row", "doc_id", "ids").mapInArrow(_decode(path, pattern), f"_row long, doc_id {kind}, raw binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each whole text, without moving its ids.

    The ids are those of ``encode``. Each distinct word's ids are decoded by the ordered aggregation in the same
    database and compared with the word; a text's decoded bytes are those of its words in turn, which is
    what decoding its ids in one go gives. A text or word of any length is treated whole.
    """
    kind = dict(docs.dtypes)[id_col]
    schema = f"_row long, doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _rows(docs, id_col, text_col).mapInArrow(_round_trip(path, pattern), schema).drop("_row")
