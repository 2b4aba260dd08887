"""Language identification by a linear-chain conditional random field over words.

Each word gets affix, character n-gram, whole-word and lexicon features; learned transitions tie
neighbours. Forward-backward gives every word a distribution over the languages, so text that
switches language is labelled word by word; a document's language is the one with the most words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import prepare_python

FOLDS = 5
SAMPLE_DOCS = 240  # learned documents per language, chosen by a hash of their id
WINDOWS, WINDOW_WORDS = 4, 40  # word windows per learned document, spread over its whole text
BUCKETS = 1 << 17  # hashed features
EPOCHS, BATCH, RATE, SHRINK = 4, 64, 0.5, 1e-5
LEXICON_COUNT, LEXICON_SHARE = 2, 0.8
BLOCK = 128  # positions of a chain that are walked side by side with other blocks
CHAIN_WORDS = 1 << 18  # words of the chains that are walked together; a longer chain is cut
CACHED_WORDS = 600_000
UNKNOWN = "und"

PIECE = 1 << 20  # characters of a text that are cut into words at once

_LETTERS, _GAP = re.compile(r"[^\W\d_]+"), re.compile(r"[\W\d_]")
_ODD, _MIX = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9E3779B97F4A7C15)


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages
    transitions: np.ndarray  # languages x languages
    start: np.ndarray
    lexicon: dict[str, int]


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from; a null id counts as an empty text, whose CRC-32 is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters (runs of other numerals and the like fall out)."""
    return [w for w in _LETTERS.findall(text.lower()) if w.isalpha() or any(c.isalpha() for c in w)]


def _pieces(text: str) -> Iterator[list[str]]:
    """The words of a text, some at a time; no run of letters is cut."""
    at = 0
    while at < len(text):
        m = _GAP.search(text, at + PIECE)
        end = m.start() if m else len(text)
        yield words_of(text[at:end])
        at = end


def word_features(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words, end to end, and how many each word has.

    A word is framed by 0 and 1; its features are its n-grams of 1 to 4 signs (those that hold the frame are
    prefixes and suffixes), its prefix and suffix of 4 letters, and the whole word.
    """
    signs = np.frombuffer("".join(f"\0{w}\1" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.array([len(w) + 2 for w in words])
    ends = np.cumsum(size)
    starts = ends - size
    place = np.arange(len(signs)) - np.repeat(starts, size)
    left = np.repeat(size, size) - place  # signs from here to the word's end
    power = _ODD ** np.arange(1, 6, dtype=np.uint64)
    found, owner = [], []
    word = np.repeat(np.arange(len(words)), size)
    gram = np.zeros(len(signs), np.uint64)
    for n in range(1, 6):
        shifted = np.zeros_like(signs)
        shifted[: len(signs) - n + 1] = signs[n - 1 :]
        gram = gram + (shifted + np.uint64(n)) * power[n - 1]
        whole = left >= n
        if n == 5:
            whole &= (place == 0) | (left == n)
        found.append(gram[whole])
        owner.append(word[whole])
    climb = _ODD ** (place % 61 + 7).astype(np.uint64) * (signs + np.uint64(3) * place.astype(np.uint64))
    found.append(np.add.reduceat(climb, starts))
    owner.append(np.arange(len(words)))
    owners = np.concatenate(owner)
    order = np.argsort(owners, kind="stable")
    hashed = (np.concatenate(found) * _MIX) >> np.uint64(64 - BUCKETS.bit_length() + 1)
    return hashed[order].astype(np.int64), np.bincount(owners, minlength=len(words))


def _lexicon_feature(language: int) -> int:
    return zlib.crc32(f"lexicon {language}".encode()) % BUCKETS


def _all_features(words: Sequence[str], known: Sequence[int | None]) -> tuple[np.ndarray, np.ndarray]:
    """``word_features`` and a lexicon feature for the words that are known."""
    flat, size = word_features(words)
    at = np.cumsum(size)
    in_lexicon = [i for i, lang in enumerate(known) if lang is not None]
    flat = np.insert(flat, at[in_lexicon], [_lexicon_feature(known[i]) for i in in_lexicon])
    size[in_lexicon] += 1
    return flat, size


def lexicon_of(counts: dict[str, np.ndarray]) -> dict[str, int]:
    """Words met at least LEXICON_COUNT times, nearly always in one language."""
    return {w: int(c.argmax()) for w, c in counts.items() if c.sum() >= LEXICON_COUNT and c.max() >= LEXICON_SHARE * c.sum()}


# forward-backward


def walk(e: np.ndarray, first: np.ndarray, a: np.ndarray, start: np.ndarray, into: np.ndarray, out: np.ndarray, pairs: bool = False):
    """Word posteriors of rows of positions (rows x positions x languages), all rows at once.

    ``first`` marks positions that begin a chain; ``into`` and ``out`` are the messages that enter each row at its
    two ends. With ``pairs`` the expected number of transitions is the second result.
    """
    n = e.shape[1]
    alpha, forward = into, np.empty_like(e)
    for t in range(n):
        alpha = np.where(first[:, t, None], start, alpha @ a) * e[:, t]
        alpha = alpha / alpha.sum(axis=1, keepdims=True)
        forward[:, t] = alpha
    beta, expected = out, np.zeros_like(a)
    for t in range(n - 1, -1, -1):
        known = e[:, t] * beta
        if pairs and t:
            x = forward[:, t - 1, :, None] * a * known[:, None, :]
            x /= x.sum(axis=(1, 2), keepdims=True)
            expected += x[~first[:, t]].sum(axis=0)
        both = forward[:, t] * beta
        forward[:, t] = both / both.sum(axis=1, keepdims=True)
        beta = np.where(first[:, t, None], 1.0, known @ a.T)
        beta = beta / beta.max(axis=1, keepdims=True)
    return forward, expected


def posteriors(scores: np.ndarray, first: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Distribution over languages at each of the positions of several chains laid end to end.

    Chains are cut into blocks of BLOCK positions. Each block's transfer matrix gives the messages at its ends, then
    all blocks are walked side by side: the result is that of walking each chain from end to end.
    """
    n, k = scores.shape
    rows = -(-n // BLOCK)
    e = np.ones((rows * BLOCK, k))
    e[:n] = np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -600.0))
    begins = np.ones(rows * BLOCK, bool)
    begins[:n] = first
    e, begins = e.reshape(rows, BLOCK, k), begins.reshape(rows, BLOCK)
    a, s = np.exp(transitions - transitions.max()), np.exp(start - start.max())
    move = np.repeat(np.eye(k)[None], rows, axis=0)
    for t in range(BLOCK):
        fresh = move.sum(axis=2, keepdims=True) * s
        move = np.where(begins[:, t, None, None], fresh, (move.reshape(-1, k) @ a).reshape(move.shape)) * e[:, t, None, :]
        move /= move.max(axis=(1, 2), keepdims=True)
    into, out = np.ones((rows, k)), np.ones((rows, k))
    for r in range(1, rows):
        x = into[r - 1] @ move[r - 1]
        into[r] = x / x.max()
        y = move[rows - r] @ out[rows - r]
        out[rows - r - 1] = y / y.max()
    return walk(e, begins, a, s, into, out)[0].reshape(-1, k)[:n]


# fit


def _sequences(windows: list[tuple[int, int, list[str]]], rng: np.random.Generator):
    """Training sequences of (words, languages, fold): each window, and as many that switch between windows of a fold."""
    plain = [(words, [lang] * len(words), fold) for fold, lang, words in windows]
    mixed = []
    for fold in sorted({f for f, _, _ in windows}):
        pool = [(lang, words) for f, lang, words in windows if f == fold]
        by_lang: dict[int, list[list[str]]] = {}
        for lang, words in pool:
            by_lang.setdefault(lang, []).append(words)
        kinds = sorted(by_lang)
        for _ in pool:
            words, langs = [], []
            while len(words) < WINDOW_WORDS:
                lang = kinds[rng.integers(len(kinds))]
                some = by_lang[lang][rng.integers(len(by_lang[lang]))]
                size = min(len(some), int(rng.integers(3, 21)), WINDOW_WORDS - len(words))
                at = int(rng.integers(len(some) - size + 1))
                words += some[at : at + size]
                langs += [lang] * size
            mixed.append((words, langs, fold))
    return plain + mixed


def _sums(group: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(group, rows[:, c], n) for c in range(rows.shape[1])], axis=1)


def fit(windows: Sequence[tuple[int, str, list[str]]], seed: int = 42) -> Model:
    """Train on ``(document, language, words)`` windows by AdaGrad on the conditional log-likelihood.

    The lexicon that a window sees comes from the documents of the other half, so that a word's own
    occurrence never vouches for it; the model's lexicon comes from both halves.
    """
    languages = sorted({lang for _, lang, _ in windows})
    k = len(languages)
    code = {lang: i for i, lang in enumerate(languages)}
    rng = np.random.default_rng(seed)
    if not windows:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((0, 0)), np.zeros(0), {})
    halves = [(zlib.crc32(str(d).encode()) % 2, code[lang], words) for d, lang, words in windows]
    counts: list[dict[str, np.ndarray]] = [{}, {}]
    for half, lang, words in halves:
        for w, c in Counter(words).items():
            counts[half].setdefault(w, np.zeros(k))[lang] += c
    both = {w: counts[0].get(w, 0) + counts[1].get(w, 0) for w in counts[0].keys() | counts[1].keys()}
    lexicons = [lexicon_of(counts[1]), lexicon_of(counts[0])]  # a half sees the other's words
    sequences = _sequences(halves, rng)

    place: dict[tuple[int, str], int] = {}
    for words, _, half in sequences:
        for w in words:
            place.setdefault((half, w), len(place))
    flat, size = _all_features([w for _, w in place], [lexicons[half].get(w) for half, w in place])
    ends = np.cumsum(size)
    value = 1 / np.sqrt(size)

    weights, transitions, start = np.zeros((BUCKETS, k)), np.zeros((k, k)), np.zeros(k)
    history = [np.full((BUCKETS, k), 1e-6), np.full((k, k), 1e-6), np.full(k, 1e-6)]

    def climb(param, past, grad, at=slice(None)):
        past[at] += grad**2
        param[at] += RATE * grad / np.sqrt(past[at])

    for _ in range(EPOCHS):
        order = rng.permutation(len(sequences))
        for lo in range(0, len(order), BATCH):
            batch = [sequences[i] for i in order[lo : lo + BATCH]]
            word = np.full((len(batch), WINDOW_WORDS), -1)
            gold = np.zeros((len(batch), WINDOW_WORDS), int)
            for i, (words, langs, half) in enumerate(batch):
                word[i, : len(words)] = [place[half, w] for w in words]
                gold[i, : len(words)] = langs
            real = word >= 0
            first = ~real
            first[:, 0] = True
            ids, back = np.unique(word[real], return_inverse=True)
            own = size[ids]
            owner, starts = np.repeat(np.arange(len(ids)), own), np.cumsum(own) - own
            entries = flat[np.arange(own.sum()) - np.repeat(starts - (ends - size)[ids], own)]
            total = np.add.reduceat(weights[entries], starts)
            score = np.zeros((*word.shape, k))
            score[real] = (total * value[ids][:, None])[back]
            e = np.where(real[..., None], np.exp(score - score.max(axis=2, keepdims=True)), 1.0)
            a, s = np.exp(transitions - transitions.max()), np.exp(start - start.max())
            ones = np.ones((len(batch), k))
            gamma, expected = walk(e, first, a, s, ones, ones, pairs=True)
            miss = np.eye(k)[gold] - gamma
            per_word = _sums(back, miss[real], len(ids)) * value[ids][:, None]
            used, spot = np.unique(entries, return_inverse=True)
            grad = _sums(spot, per_word[owner], len(used))
            climb(weights, history[0], grad / BATCH - SHRINK * weights[used], used)
            observed = np.zeros((k, k))
            inner = ~first[:, 1:]
            np.add.at(observed, (gold[:, :-1][inner], gold[:, 1:][inner]), 1)
            climb(transitions, history[1], (observed - expected) / BATCH)
            climb(start, history[2], miss[:, 0].sum(axis=0) / BATCH)
    return Model(languages, weights.astype(np.float32), transitions, start, lexicon_of(both))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Up to WINDOWS runs of WINDOW_WORDS words, evenly spread over each whole text."""
    for batch in batches:
        rows: dict[str, list] = {"doc": [], "lang": [], "words": []}
        for doc, lang, text in zip(*(batch.column(c) for c in ("doc", "lang", "t")), strict=True):
            words = words_of(text.as_py())
            n = min(WINDOWS, -(-len(words) // WINDOW_WORDS))
            for i in range(n):
                at = i * max(0, len(words) - WINDOW_WORDS) // max(1, n - 1)
                rows["doc"].append(doc.as_py())
                rows["lang"].append(lang.as_py())
                rows["words"].append(" ".join(w[:1024] for w in words[at : at + WINDOW_WORDS]))
        yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("doc", pa.string()), ("lang", pa.string()), ("words", pa.string())]))


def sample_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit on about ``sample_docs`` documents per language (at most WINDOWS x WINDOW_WORDS words of each).

    The documents are those of least hash among rows with a language that are not ``held_out``; the bound is the classifier's
    labelled sample, so neither the driver's rows nor its time grow with the table.
    """
    prepare_python(docs.sparkSession)
    known = docs.select(F.col(id_col).cast("string").alias("doc"), F.col(lang_col).alias("lang"), F.col(text_col).alias("t"))
    known = known.where(~held_out(F.col("doc")) & F.col("lang").isNotNull() & F.col("t").isNotNull())
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("c"))
    # a row per language; the rate leaves half as many again, so that the least hashes are among them
    rates = F.broadcast(sizes.select("lang", F.least(F.lit(1.0), F.lit(1.5 * sample_docs) / F.col("c")).alias("rate")))
    place = F.pmod(F.xxhash64("doc", F.lit(13)), F.lit(1 << 30))
    drawn = known.withColumn("place", place).join(rates, "lang").where(F.col("place") < F.col("rate") * (1 << 30))
    rows = drawn.select("doc", "lang", "t").mapInArrow(_windows, "doc string, lang string, words string").collect()
    taken: dict[str, dict[str, list[str]]] = {}
    for r in rows:
        taken.setdefault(r["lang"], {}).setdefault(r["doc"], []).append(r["words"])
    windows = []
    for lang in sorted(taken):
        for doc in sorted(taken[lang], key=lambda d: (zlib.crc32(d.encode()), d))[:sample_docs]:
            windows += [(doc, lang, words.split(" ")) for words in sorted(taken[lang][doc])]
    return fit(windows)


# prediction


class _Reader:
    """Turns texts into word scores, remembering words."""

    def __init__(self, model: Model):
        self.model = model
        self.place: dict[str, int] = {}
        self.table = np.zeros((1024, len(model.languages)))

    def _learn(self, words: list[str]) -> None:
        flat, size = _all_features(words, [self.model.lexicon.get(w) for w in words])
        scores = np.add.reduceat(self.model.weights[flat].astype(float), np.cumsum(size) - size) / np.sqrt(size)[:, None]
        at = len(self.place)
        if at + len(words) > len(self.table):
            self.table = np.vstack([self.table[:at], scores, np.zeros((at + len(words), scores.shape[1]))])
        self.table[at : at + len(words)] = scores
        self.place.update(zip(words, range(at, at + len(words)), strict=True))

    def scores(self, words: list[str]) -> np.ndarray:
        """A row per word. New words are learned together; a full memory starts anew."""
        if len(self.place) > CACHED_WORDS:
            self.place.clear()
        new = list({w for w in words if w not in self.place})
        if new:
            self._learn(new)
        return self.table[[self.place[w] for w in words]]

    def chains(self, texts: Iterator[str]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
        """(texts, posteriors of a stretch of each's words), several texts at a time."""
        owners: list[int] = []
        words: list[str] = []
        ends: list[int] = []

        def solve():
            first = np.zeros(len(words), bool)
            first[[0, *ends[:-1]]] = True
            found = posteriors(self.scores(words), first, self.model.transitions, self.model.start)
            return owners, np.split(found, ends[:-1])

        for i, text in enumerate(texts if self.model.languages else ()):
            for some in _pieces(text):
                if not some:
                    continue
                if words and len(words) + len(some) > CHAIN_WORDS:
                    yield solve()
                    owners, words, ends = [], [], []
                if owners and owners[-1] == i:
                    ends[-1] += len(some)
                else:
                    owners.append(i)
                    ends.append(len(words) + len(some))
                words += some
        if words:
            yield solve()


def _predict(model: Model):
    def run(batches):
        reader = _Reader(model)
        for batch in batches:
            total = np.zeros((batch.num_rows, len(model.languages)))
            for owners, parts in reader.chains(x.as_py() or "" for x in batch.column("t")):
                for i, p in zip(owners, parts, strict=True):
                    total[i] += p.sum(axis=0)
            words = total.sum(axis=1)
            best = total.argmax(axis=1) if model.languages else np.zeros(len(words), int)
            lang = [model.languages[b] if n else UNKNOWN for b, n in zip(best, words, strict=True)]
            # rounded, as sums differ in their last bits with a text's place in the batch
            share = [min(1.0, round(float(t[b] / n), 9)) if n else 0.0 for t, b, n in zip(total, best, words, strict=True)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "lang_pred": pa.array(lang, pa.string()), "score": pa.array(share, pa.float64())})

    return run


def _runs(model: Model):
    def run(batches):
        reader = _Reader(model)
        kind = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))
        for batch in batches:
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for owners, parts in reader.chains(x.as_py() or "" for x in batch.column("t")):
                for i, p in zip(owners, parts, strict=True):
                    best = p.argmax(axis=1)
                    cuts = np.concatenate([[0], np.flatnonzero(np.diff(best)) + 1, [len(best)]])
                    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                        lang = model.languages[best[lo]]
                        if found[i] and found[i][-1]["lang"] == lang:
                            found[i][-1]["words"] += hi - lo
                        else:
                            found[i].append({"lang": lang, "words": hi - lo})
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "runs": pa.array(found, kind)})

    return run


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    prepare_python(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row: the language of most words, and its share of them.

    * null text, and text without a letter, is ``und`` with score 0, as is all text where nothing was learned;
    * equal texts get equal languages; repeated rows are predicted like any other; ties go to the first language by name;
    * a text of any length is read whole; a chain begins anew after about CHAIN_WORDS words;
    * other columns are ignored; an empty table gives an empty result.
    """
    kind = dict(docs.dtypes)[id_col]
    found = _texts(docs, id_col, text_col).mapInArrow(_predict(model), f"doc_id {kind}, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def language_runs(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, runs``: the text's stretches of one language, in order, each with its number of words."""
    kind = dict(docs.dtypes)[id_col]
    return _texts(docs, id_col, text_col).mapInArrow(_runs(model), f"doc_id {kind}, runs array<struct<lang: string, words: bigint>>")
