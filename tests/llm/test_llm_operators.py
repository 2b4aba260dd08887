"""Operators of kestrel.llm against brute force, and their defined results in odd cases."""

import hashlib
import math
import random
import re
import textwrap
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")

from kestrel.llm import (  # noqa: E402
    bpe,
    exact_dedup,
    html_blocks,
    html_extract,
    license_rules,
    mixing,
    simhash,
    suffix_dedup,
    suffix_merge,
    syncmers,
    toxicity,
    url_reputation,
)

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
# extra columns whose names clash with those that operators use
SCHEMA = "doc_id long, text string, source string, t string, _row string, kept string, size string, fp string, h string, n string, rank string, d string, toxic string"


def words(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "Gamma", "delta", "épée", "omega", "kappa"]) + str(rng.randint(0, 40)) for _ in range(n))


def odd_rows():
    rng = random.Random(5)
    texts = [words(rng, rng.randint(1, 60)) for _ in range(40)]
    rows = [(i, t, f"s{i % 4}") for i, t in enumerate(texts)]
    rows += [(100, None, "s1"), (101, "", "s1"), (102, "   \n\t ", None), (None, texts[3], None), (None, None, None)]
    rows += [(103, texts[5], "s2"), (103, texts[5], "s2"), (104, texts[5], None), (105, texts[0] + " tail", "s0")]
    rows += [(106, words(rng, 30_000), "s3"), (107, "x" * 5000, "s3"), (108, "one", "s0"), (109, "one two", "s0")]
    return rows


def table_of(spark, tmp_path, rows, schema=SCHEMA):
    width = len(schema.split(","))
    full = [(*r, *["x"] * (width - len(r))) for r in rows]
    path = str(tmp_path / "docs.parquet")
    spark.createDataFrame(full, schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return table_of(spark, tmp_path_factory.mktemp("odd"), odd_rows())


@pytest.fixture(scope="module")
def none(spark, tmp_path_factory):
    return table_of(spark, tmp_path_factory.mktemp("none"), [])


def key(r):
    return tuple((x is None, x) for x in r)


# exact dedup


def test_exact_dedup_keeps_one_row_of_each_text(odd):
    got = exact_dedup.duplicate_groups(odd).collect()
    rows = odd_rows()
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(t or "", []).append(i)
    assert len(got) == len(rows)
    digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = digest[r["text_sha256"]]
        known = [i for i in ids if i is not None]
        assert r["group_size"] == len(ids) and r["keep_id"] == (max(known) if known else None)
    for sha, ids in digest.items():
        kept = [r for r in got if r["text_sha256"] == sha and r["kept"]]
        assert len(kept) == 1 and kept[0]["doc_id"] == kept[0]["keep_id"]
    left = exact_dedup.drop_duplicates(odd)
    assert left.columns == odd.columns and left.count() == len(groups)


def test_exact_dedup_tells_texts_apart_behind_equal_prefixes(spark, tmp_path):
    rows = [(i, "p" * 200 + str(i % 3), "s") for i in range(9)]
    got = exact_dedup.duplicate_groups(table_of(spark, tmp_path, rows)).collect()
    assert {r["doc_id"] for r in got if r["kept"]} == {6, 7, 8} and {r["group_size"] for r in got} == {3}


# mixing


def water_filling(sizes, weights=(3, 1, 2), share=1.5, repeats=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        if not free:
            break
        level = (total - sum(repeats * sizes[s] for s in capped)) / sum(w[s] for s in free)
        over = [s for s in free if w[s] * level > repeats * sizes[s]]
        if not over:
            break
        capped |= set(over)
    return {s: repeats * sizes[s] if s in capped else w[s] * level for s in names}


def test_mix_comes_near_targets_and_repeats_twice_at_most(odd):
    got = mixing.mix(odd).documents.collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, s in odd_rows():
        sizes[s] = sizes.get(s, 0) + size(t)
    target = water_filling(sizes)
    assert sorted((r["doc_id"] is None, r["doc_id"], r["size"]) for r in got if r["doc_id"] is not None) == sorted((False, i, size(t)) for i, t, _ in odd_rows() if i is not None)
    taken = {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(0.05 * t, 2)
    again = mixing.mix(odd).documents.collect()
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_quotas_are_the_highest_quotients(odd):
    plan = mixing.mix(odd, blocks_per_shard=16)
    quotas = plan.quotas.collect()
    total = {}
    for r in quotas:
        total[r["source"]] = total.get(r["source"], 0) + r["quota"]
    shards = {}
    for r in quotas:
        shards.setdefault(r["shard"], {})[r["source"]] = r["quota"]
    target = {r["source"]: r["target"] for r in plan.documents.collect()}
    assert all(sum(q.values()) == 16 for s, q in shards.items() if s != max(shards))
    seats = dict.fromkeys(target, 0)
    for s in sorted(shards):  # every prefix of shards is a Sainte-Lague apportionment
        for name, q in shards[s].items():
            seats[name] += q
        lowest_won = min(target[n] / (2 * k - 1) for n, k in seats.items() if k)
        highest_lost = max(t / (2 * seats[n] + 1) for n, t in target.items())
        assert lowest_won >= highest_lost * (1 - 1e-9)


def test_mixed_documents_keep_columns(odd):
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns and out.count() > 0


def test_small_sources_beside_a_large_one_meet_their_targets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCKS", 1 << 8)
    rows = [(i, "w " * 1000, "en", "s0", 0) for i in range(60)] + [(100 + i, "w " * 8, "en", "s1", 0) for i in range(5)]
    rows += [(200 + i, "w " * 50, "en", "s2", 0) for i in range(7)]
    taken = {}
    for r in mixing.mix(table_of(spark, tmp_path, rows), blocks_per_shard=16).documents.collect():
        assert r["taken"] <= mixing.MAX_REPEATS * r["size"]
        target, got = taken.get(r["source"], (r["target"], 0))
        taken[r["source"]] = (target, got + r["taken"])
    assert all(abs(got - target) <= max(0.05 * target, 2) for target, got in taken.values()), taken


@pytest.mark.parametrize("low, high, sources", [(5000, 20000, 4), (3000, 9000, 3)])
def test_copies_of_long_documents_meet_their_targets(spark, tmp_path, low, high, sources):
    rng = random.Random(low)
    sizes = {i: rng.randint(low, high) for i in range(40 * sources)}
    rows = [(i, "w " * n, "en", f"s{i % sources}", 0) for i, n in sizes.items()]
    docs = table_of(spark, tmp_path, rows)
    plan = {r["doc_id"]: r for r in mixing.mix(docs).documents.collect()}
    copies = Counter(r["doc_id"] for r in mixing.mixed_documents(docs).select("doc_id").collect())
    for s in {r["source"] for r in plan.values()}:
        of = [r for r in plan.values() if r["source"] == s]
        words = sum(copies[r["doc_id"]] * r["size"] for r in of)
        assert abs(words - sum(r["taken"] for r in of)) <= max(r["size"] for r in of) / 2
        assert abs(words - of[0]["target"]) <= max(r["size"] for r in of)
    assert all(math.floor(r["taken"] / r["size"]) <= copies[i] <= math.ceil(r["taken"] / r["size"]) for i, r in plan.items())
    assert max(copies.values()) <= mixing.MAX_REPEATS


def test_copies_do_not_favour_a_size(spark, tmp_path):
    rows = [(i, "w " * (4000 if i % 2 else 40), "en", f"s{i % 3}", 0) for i in range(1200)]
    docs = table_of(spark, tmp_path, rows)
    plan = {r["doc_id"]: r for r in mixing.mix(docs).documents.collect()}
    copies = Counter(r["doc_id"] for r in mixing.mixed_documents(docs).select("doc_id").collect())
    for s in {r["source"] for r in plan.values()}:
        for size in (40, 4000):
            of = [r for r in plan.values() if r["source"] == s and r["size"] == size]
            assert abs(sum(copies[r["doc_id"]] for r in of) / len(of) - of[0]["target"] / of[0]["source_size"]) < 0.15


# simhash


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_simhash_components_match_all_pairs(odd):
    got = simhash.near_duplicates(odd).collect()
    rows = odd_rows()
    fps = [slow_fingerprint(t) for _, t, _ in rows]
    assert sorted(r["fp"] % (1 << 64) for r in got) == sorted(fps)
    root = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(len(rows)):
                if (fps[a] ^ fps[b]).bit_count() <= 3:
                    root[a] = root[b] = min(root[a], root[b])
    groups = {}
    for k, (i, _, _) in enumerate(rows):
        groups.setdefault(root[k], []).append(i)
    want = {fps[k]: min((i for i in groups[root[k]] if i is not None), default=None) for k in range(len(rows))}
    assert all(r["component_id"] == want[r["fp"] % (1 << 64)] for r in got)
    assert simhash.drop_near_duplicates(odd).count() == len(groups)


@pytest.mark.parametrize("dense", [False, True])
def test_gray_index_links_what_all_pairs_link(dense):
    rng = np.random.default_rng(2 + dense)
    centres = rng.integers(0, 2**64, 8 if dense else 60, dtype=np.uint64)
    flips = [sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for _ in range(900)]
    fps = np.unique(np.array([int(centres[i % len(centres)]) ^ f for i, f in enumerate(flips)], np.uint64))
    segment = (fps >> np.uint64(63)).astype(int)
    rank = fps.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    order = np.lexsort((rank, segment))
    fps, segment = fps[order], segment[order]
    root = simhash._roots(len(fps), *simhash.GrayIndex(fps, segment).links(3))
    a, b = np.nonzero((np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3) & (segment[:, None] == segment[None, :]))
    assert (root == simhash._roots(len(fps), a, b)).all()


def test_hot_blocks_are_split_without_losing_links(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT_ROWS", 20)
    rng = random.Random(1)
    fps = {0xABCD << 48 | rng.getrandbits(12) for _ in range(300)}
    df = spark.createDataFrame([(f - (1 << 64),) for f in fps], "fp long")
    links = simhash.fingerprint_links(df)
    got = {r["u"]: r["root"] for r in simhash.components(links).collect()}
    xs = np.array(sorted(f - (1 << 64) for f in fps), np.int64)
    near = np.nonzero(np.bitwise_count((xs[:, None] ^ xs[None, :]).view(np.uint64)) <= 3)
    root = xs[simhash._roots(len(xs), *near)]
    assert all(got.get(int(x), int(x)) == int(r) for x, r in zip(xs, root, strict=True))


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(300)] + [(1000, 1001), (7, 7)], "u long, v long")
    got = {r["u"]: r["root"] for r in simhash.components(links).collect()}
    assert all(got[i] == 0 for i in range(1, 301)) and got[1001] == 1000


# byte-level BPE


def encoding():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_bpe_round_trip_matches_the_library(odd):
    enc = encoding()
    got = sorted(map(key, bpe.round_trip(odd, RANKS, PATTERN).collect()))
    want = []
    for i, t, _ in odd_rows():
        ids = enc.encode_ordinary(t or "")
        want.append(key((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())))
    assert got == sorted(want)


def test_bpe_encode_then_decode(odd):
    encoded = bpe.encode(odd, RANKS, PATTERN)
    raw = sorted(bytes(r["raw"]) for r in bpe.decode(encoded, RANKS, PATTERN).collect())
    assert raw == sorted((t or "").encode() for _, t, _ in odd_rows())


def test_bpe_of_long_and_strange_words():
    rng = random.Random(0)
    texts = ["a" * 700, "ab" * 400, "日本語" * 90, " " * 500 + "x", "=-" * 300, "é" * 333, "\n\n \t x  ", "don't we'll I'M", "".join(rng.choices("ACGT", k=600))]
    texts += ["".join(rng.choices("abcdefghijklm", k=n)) for n in (95, 96, 97, 300)]
    t, enc = bpe.tokenizer(RANKS, PATTERN), encoding()
    out = [b""] * len(texts)
    for d, found in bpe._words(t, texts):
        out[d] += b"".join(t.ids[w] for w in found)
    assert [np.frombuffer(o, "<u4").tolist() for o in out] == [enc.encode_ordinary(x) for x in texts]


def test_bpe_pieces_join_to_the_text(monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 10)
    enc = encoding()
    for text in ("aa  bb   cc\n\ndd " * 20, "x" * 50, " lead and  trail  ", ""):
        pieces = list(bpe._cuts(text))
        assert "".join(pieces) == text and sum((enc.encode_ordinary(p) for p in pieces), []) == enc.encode_ordinary(text)


# suffix dedup


def slow_removal(docs, size=100):
    seen, out = set(), []
    for i, t in docs:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - size + 1):
            if raw[p : p + size] in seen:
                gone[p : p + size] = b"\1" * size
            seen.add(raw[p : p + size])
        spans = sum(1 for k in range(len(gone)) if gone[k] and (not k or not gone[k - 1]))
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(raw, gone, strict=True) if not g)).hexdigest()))
    return out


def passages():
    rng = random.Random(3)
    base, line = words(rng, 120), "a line of seventy bytes or so that very many of the texts have in them."
    docs = [(i, words(rng, rng.randint(5, 40)) + line + words(rng, 9)) for i in range(40)]
    docs += [(100, base), (101, base), (102, base[:333] + "Q" + base[333:]), (103, base[50:150]), (104, base[50:149]), (105, "a" * 900), (106, "xy" * 200 + "a" * 150)]
    docs += [(200 + k, base[k * 7 : k * 7 + rng.randint(90, 220)] + words(rng, 12) + base[: rng.randint(30, 160)]) for k in range(40)]
    docs += [(300, None), (301, ""), (302, "é" * 300), (303, "".join(rng.choices("ab", k=2500))), (304, words(rng, 20_000) + base)]
    return docs


def test_suffix_dedup_matches_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RANGE_ENTRIES", 64)  # many merge ranges
    docs = passages()
    got = suffix_dedup.remove_repeats(table_of(spark, tmp_path, [(i, t, "s") for i, t in docs])).drop("_row").collect()
    assert sorted(map(tuple, got)) == sorted(slow_removal(docs))


def test_suffix_dedup_of_odd_rows(odd, none):
    got = suffix_dedup.remove_repeats(odd).collect()
    rows = sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"], r["_row"]))
    by_text = {len((t or "").encode()): t for _, t, _ in odd_rows()}
    assert [r["n_bytes"] for r in rows] and sum(r["n_bytes"] for r in rows) == sum(len((t or "").encode()) for _, t, _ in odd_rows()) and by_text
    twice = [r for r in rows if r["doc_id"] == 103]
    assert all(r["n_removed"] in (0, r["n_bytes"]) for r in twice)
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_anchors_are_the_same_for_equal_windows():
    rng = np.random.default_rng(0)
    raw = rng.integers(97, 100, 4000).astype(np.uint8)
    raw[3000:3500] = raw[500:1000]
    h, at, first, last = suffix_dedup.anchors(raw, np.array([0]), np.array([4000 - 100]))
    anchor = {}
    for i in range(len(h)):
        for p in range(first[i], last[i] + 1):
            anchor[p] = (int(h[i]), int(at[i]) - p)
    assert len(anchor) == 3901 and all(anchor[500 + k] == anchor[3000 + k] for k in range(401))


def test_merge_keeps_order_and_prefix_lengths():
    rng = random.Random(0)
    for _ in range(60):
        runs, everything = [], []
        for r in range(rng.randint(0, 9)):
            entries = sorted({bytes(rng.choices(b"ab", k=rng.randint(0, 40))) + suffix_merge.place(rng.choice([None, -5, 7]), r, rng.randint(0, 99)) for _ in range(50)})
            everything += entries
            runs.append(suffix_merge.unpack(suffix_merge.pack(entries)))
        got = list(suffix_merge.merge(runs))
        assert [e for _, e in got] == sorted(everything)
        for (_, a), (k, b) in zip(got, got[1:], strict=False):
            assert a[:k] == b[:k] and a[k : k + 1] != b[k : k + 1]


# syncmers


def test_next_texts_follow_descending_ids(spark, tmp_path):
    rows = [(i * 3, f"text {i}", "s") for i in range(500)] + [(None, "nobody", "s")]
    got = {r["t"]: r["next_t"] for r in syncmers.with_next(table_of(spark, tmp_path, rows), rows_per_bucket=7).collect()}
    order = [t for i, t, _ in sorted(rows, key=lambda r: -1 if r[0] is None else r[0], reverse=True)]
    assert got == dict(zip(order, order[1:] + order[:1], strict=True))


def test_edited_texts_and_likeness(odd, none):
    got = syncmers.fingerprint_edits(odd).collect()
    rows = sorted(((i, t or "") for i, t, _ in odd_rows()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(t) // 2
        want.append((i, len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()))
    assert sorted(key(r[:3]) for r in map(tuple, got)) == sorted(map(key, want))
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    long_ = [r for r in got if r["n_chars"] > 300 and r["doc_id"] != 107]
    assert np.mean([r["near_edited"] for r in long_]) > 0.3
    assert syncmers.fingerprint_edits(none).count() == 0


def test_closed_syncmers_are_context_free(spark):
    rng = random.Random(2)
    passage = words(rng, 40)
    df = spark.createDataFrame([(words(rng, 13) + " " + passage + " " + words(rng, 9), passage, "", "one two")], "a string, b string, c string, d string")
    r = df.select(*[syncmers.syncmers(F.col(c)).alias(c) for c in "abcd"]).first()
    a, b = {x["hash"]: x["pos"] for x in r["a"]}, {x["hash"]: x["pos"] for x in r["b"]}
    assert b and all(a[h] - p == 13 for h, p in b.items())
    assert r["c"] == [] and len(r["d"]) == 1
    pairs = df.select(syncmers.shared_anchors(syncmers.syncmers(F.col("a")), syncmers.syncmers(F.col("b"))).alias("m")).first()["m"]
    assert {m["pos_a"] - m["pos_b"] for m in pairs} == {13}


# toxicity


def test_toxicity_learns_marks_and_never_reads_held_out_labels(spark, tmp_path):
    rng = random.Random(4)
    marks = ["idiot", "scum", "zorkab", "zorkin"]
    rows, labels = [], []
    for i in range(900):
        bad = i % 6 == 0
        t = words(rng, 30) + (" " + rng.choice(marks) + " you " + rng.choice(marks) if bad else "")
        rows.append((i, t, "s"))
        labels.append((i, int(bad)))
    rows += [(5000, None, "s"), (5001, "", "s"), (5002, "x " * 40_000 + "zorkab scum", "s"), (None, rows[0][1], "s")]
    docs = table_of(spark, tmp_path, rows)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs, toxicity.sample_model(docs, lab)).collect()}
    import zlib

    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i]["held_out"] == (i in set(held)) for i in range(900))
    right = [got[i]["predicted"] == int(i % 6 == 0) for i in held]
    assert sum(right) >= 0.99 * len(right)
    assert got[5000]["score"] == got[5001]["score"] and got[5000]["predicted"] == 0
    assert got[None]["score"] == got[0]["score"]
    # flipping the labels of held-out rows changes nothing
    flipped = spark.createDataFrame([(i, 1 - y if i in set(held) else y) for i, y in labels], "doc_id long, toxic int")
    again = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.sample_model(docs, flipped)).collect()}
    assert all(again[i] == got[i]["score"] for i in range(900))
    assert toxicity.drop_toxic(docs, lab).columns == docs.columns


def test_toxicity_without_labels_or_rows(spark, odd, none):
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["predicted"] for r in toxicity.score(odd, toxicity.sample_model(odd, empty)).collect()} == {0}
    assert toxicity.score(none, toxicity.sample_model(none, empty)).count() == 0


def test_word_sets_do_not_depend_on_pieces(monkeypatch):
    text = "alpha beta_1 gamma " * 30 + "z" * 50
    whole = toxicity._word_set(text)
    monkeypatch.setattr(toxicity, "PIECE", 7)
    assert toxicity._word_set(text) == whole


# URL reputation


def test_url_parts_and_rules(spark):
    urls = ["HTTP://WWW.Example.ORG/es/1", "https://example.org", "x://a.org?q=/es/", "http://example.org/en/12#f", "no scheme", None, "http://é.com/de/x?y", "a://b://c/fr/", "http://notexample.org/es/"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    host, path = url_reputation.url_parts(F.col("url"))
    rows = df.select("url", host.alias("h"), path.alias("p"), url_reputation.rule_of(host, path, url_reputation.RULES).alias("r")).collect()
    got = {r["url"]: (r["h"], r["p"], r["r"] and tuple(r["r"])) for r in rows}
    assert got[urls[0]] == ("www.example.org", "/es/1", ("example.org/es/", "block"))
    assert got[urls[1]] == ("example.org", "", None) and got[urls[2]] == ("a.org", "", None)
    assert got[urls[3]] == ("example.org", "/en/12", ("example.org/en/1", "block"))
    assert got["no scheme"] == ("", "", None) and got[None] == ("", "", None)
    assert got[urls[6]] == ("é.com", "/de/x", ("com/de/", "block")) and got[urls[7]][:2] == ("b:", "//c/fr/")
    assert got[urls[8]][2] == ("org/", "allow")


def test_reputation_blocks_only_hosts_known_to_be_bad(spark, tmp_path):
    pages, outcomes = [], []
    for i in range(400):
        bad = i % 4 == 0
        pages.append((i, f"http://{'bad' if bad else 'good'}{i % 8}.site.net/p/{i}", "h"))
        if i % 2 == 0:
            outcomes.append((i, 0 if bad else 1))
    pages += [(900, "http://new.site.net/p", "h"), (901, "http://rare.site.net/p", "h"), (902, None, "h"), (902, None, "h")]
    outcomes.append((901, 0))
    df = table_of(spark, tmp_path, pages, "page_id long, url string, html string, host string, upper string, m string")
    got = {r["page_id"]: r for r in url_reputation.filter_urls(df, spark.createDataFrame(outcomes, "page_id long, good int")).collect()}
    assert all((got[i]["verdict"] == "block") == (i % 4 == 0) for i in range(400) if i % 2 == 0)
    assert got[900]["verdict"] == "allow" and got[901]["verdict"] == "allow" and got[902]["host"] == ""
    assert url_reputation.filter_urls(df.limit(0), spark.createDataFrame([], "page_id long, good int")).count() == 0


# licence rules


def test_licence_rules(spark):
    mit = """
 * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software and associated documentation files (the "Software"), to deal
 * in the Software without restriction, including without limitation the rights
 * to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
 * copies of the Software, and to permit persons to whom the Software is
 * furnished to do so, subject to the following conditions:
"""
    notice = "\n * The above copyright notice and this permission notice shall be included in all\n * copies or substantial portions of the Software.\n"
    texts = {
        "a": "Some words.\nReleased under the MIT License.\nMore words.",
        "b": "x | y | z\nLicensed under CC BY-NC 4.0.",
        "c": "Licensed under the Apache License, Version 2.0.\nAll rights reserved.",
        "d": "The licence of this text is not known.",
        "e": "// SPDX-License-Identifier: GPL-3.0-only\nint main;",
        "f": None,
        "g": "",
        "h": "This program is free software; you can redistribute it and/or modify it.",
    }
    df = spark.createDataFrame([(k, t) for k, t in texts.items()] + [("i", mit + notice)], "doc_id string, text string")
    got = {r["doc_id"]: (r["n_known"], r["licenses"]) for r in license_rules.scan(df).collect()}
    assert got["a"] == (1, "MIT") and got["b"] == (1, "CC-BY-NC-4.0") and got["c"] == (2, "All-rights-reserved,Apache-2.0")
    assert got["d"] == got["f"] == got["g"] == got["h"] == (0, "")
    assert got["e"] == (1, "GPL-3.0-only") and got["i"][0] >= 1


# published sentences that are not read off their normal form
PUBLISHED = {
    "MITgrant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n',
    "MITwarranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "MITliability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "BSDgrant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n",
    "BSDsource": "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n",
    "BSDbinary": "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n",
    "BSDendorse": "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n",
    "BSDwarranty": '\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    "ISCgrant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "APACHEref": "Licensed under the Apache License, Version 2.0.",
    "APACHElong": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "APACHEcopy": "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\n",
    "APACHEbasis": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "GPLfree2": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.\n\n",
    "GPLfree3": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.\n\n",
    "GPLhope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "MPLform": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MPLcopy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "CCBY": "Licensed under CC BY 4.0.",
    "CCBYSA": "Licensed under CC BY-SA 4.0.",
    "CCBYNC": "Licensed under CC BY-NC 4.0.",
    "CCBYND": "Licensed under CC BY-ND 4.0.",
    "CC0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "SPDXmit": "SPDX-License-Identifier: MIT",
    "SPDXapache": "SPDX-License-Identifier: Apache-2.0",
    "SPDXgpl2": "SPDX-License-Identifier: GPL-2.0-only",
    "SPDXgpl3": "SPDX-License-Identifier: GPL-3.0-only",
    "SPDXbsd3": "SPDX-License-Identifier: BSD-3-Clause",
}


def published(sequence, marker, margin, width):
    text = " ".join(PUBLISHED.get(x, license_rules.SENTENCES[x].capitalize() + ".") for x in sequence)
    text = re.sub(r"(?m)^ *(\d)\. ", lambda m: marker(m[1]), text)
    lines = [part for line in text.split("\n") for part in (textwrap.wrap(line, width, break_long_words=False, break_on_hyphens=False) or [""])]
    return "\n".join(margin + x for x in lines)


def test_every_rule_finds_its_published_text(spark):
    markers = [lambda n: f"{n}. ", lambda n: f"{n}) ", lambda n: f"({'abc'[int(n) - 1]}) ", lambda n: "* "]
    rows = []
    for i, (_, sequence) in enumerate(license_rules.RULES):
        for marker in markers:
            for margin, width in (("", 72), (" * ", 60), ("# ", 10_000)):
                rows.append((i, published(sequence, marker, margin, width)))
    out = license_rules.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert len(out) == len(rows)
    missed = set()
    for r in out:
        name, sequence = license_rules.RULES[r["doc_id"]]
        if name not in r["licenses"].split(",") or not set(sequence) <= set(r["sentences"].split(",")):
            missed.add((name, sequence, r["sentences"]))
    assert not missed
    one_line = " ".join(PUBLISHED[x].strip() for x in ("BSDgrant", "BSDsource", "BSDbinary", "BSDwarranty"))
    one = license_rules.scan(spark.createDataFrame([(0, one_line)], "doc_id int, text string")).first()
    assert one["licenses"] == "BSD-2-Clause"


def test_every_known_sentence_has_a_cue_and_is_normal():
    for s in license_rules.SENTENCES.values():
        assert re.search(license_rules.CUES, s) and re.sub("[^a-z0-9]+", " ", s).strip() == s
    assert all(set(seq) <= set(license_rules.SENTENCES) for _, seq in license_rules.RULES)


def test_earlier_rules_take_their_sentences(spark):
    ids = ["?", "GPLfree2", "GPLhope", "GPLsee", "?", "MITref"]
    df = spark.createDataFrame([(ids,)], "ids array<string>")
    assert df.select(license_rules.match_rules(F.col("ids")).alias("x")).first()["x"] == ["GPL-2.0-or-later", "MIT"]


# HTML


PAGE = """<!DOCTYPE html><html><head><title>The title</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">alpha</a><li><a href="/b">beta</a></ul></nav><!-- x --><div class="ad">buy kappa now</div>
<article><h1>Alpha &amp; beta</h1><p><b>First
 paragraph</b> of omega12 words,<br>here.<p>Second para&shy;graph of delta3 and gamma4 words that go on.</article>
<div id="comments"><div class="comment"><p>a reader said omega7 here</p></div></div><footer>&copy; site</footer></body></html>"""


def test_blocks_of_a_page():
    got = html_blocks.blocks(PAGE)
    assert [b.text for b in got][:4] == ["The title", "alpha", "beta", "buy kappa now"]
    assert "Alpha & beta" in [b.text for b in got] and "First paragraph of omega12 words, here." in [b.text for b in got]
    assert got[1].linked == 1 and got[3].path[-2:] == ("div", ".ad")
    assert html_blocks.blocks("") == [] and html_blocks.blocks("<<<>< a < b") and html_blocks.blocks("<p class='x")  is not None


def test_html_extract_finds_the_article(spark, tmp_path):
    rng = random.Random(6)
    made = html_extract._Maker([words(rng, 60) for _ in range(40)], 3)
    pages = []
    for i in range(60):
        pages.append((i, f"u{i}", PAGE.replace("omega12", words(rng, 40)).replace("delta3", words(rng, 30))))
    pages += [(100, None, None), (101, "u", ""), (102, "u", "<p>"), (None, "u", PAGE), (103, "u", "<div>" * 3000 + "deep alpha" + "</div>" * 10)]
    df = table_of(spark, tmp_path, pages, "page_id long, url string, html string, text string, x string, h string")
    model = html_extract.sample_model(df)
    got = {r["page_id"]: r["text"] for r in html_extract.extract(df, model).collect()}
    assert got[100] == got[101] == got[102] == ""
    for i in range(60):
        assert got[i].startswith("Alpha & beta\n\nFirst paragraph") and got[i].endswith("go on.") and "reader" not in got[i] and "kappa now" not in got[i]
    # unseen generated layouts
    model_pages = [made.page() for _ in range(80)]
    keep = model.predict([html_extract.vectors(b) for b, _ in model_pages])
    right = np.concatenate([k == (y > 0.5) for k, (_, y) in zip(keep, model_pages, strict=True)])
    assert right.mean() > 0.93


def test_gradient_of_the_labeller():
    rng = np.random.default_rng(0)
    net = html_extract.Labeller(width=5, hidden=3)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    pages = [rng.normal(size=(n, 5)) for n in (4, 2, 3)]
    labels = [rng.integers(0, 2, len(p)).astype(float) for p in pages]
    x, mask, y = html_extract._padded(pages, labels)
    x = x.astype(np.float64)

    def loss():
        z = net.logits(x, mask)
        return (np.where(mask, np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - z * y, 0)).sum() / mask.sum()

    grad = net.gradient(x, mask, y)
    for name, w in net.w.items():
        i = tuple(int(rng.integers(s)) for s in w.shape)
        w[i] += 1e-3
        up = loss()
        w[i] -= 2e-3
        down = loss()
        w[i] += 1e-3
        assert grad[name][i] == pytest.approx((up - down) / 2e-3, rel=0.02, abs=1e-5), name


# whole operators on empty tables


def test_empty_tables(none):
    assert exact_dedup.duplicate_groups(none).count() == 0
    assert mixing.mix(none).documents.count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert bpe.round_trip(none, RANKS, PATTERN).count() == 0
    assert license_rules.scan(none).count() == 0
    pages = none.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"), F.col("text").alias("html"))
    assert html_extract.extract(pages).count() == 0
