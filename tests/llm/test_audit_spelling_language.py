"""Filter audit, spelling variants and language CRF against brute force, and their defined odd cases."""

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from kestrel.llm import filter_audit, language_crf, spelling

# extra columns whose names clash with those that operators use
SCHEMA = "doc_id long, text string, source string, lang string, n string, word string, mask string, part string, region string, t string, toxic string"
LABELS = "doc_id long, quality int, toxic int, part string, n string"


def frame(spark, tmp_path, name, rows, schema):
    width = len(schema.split(","))
    path = str(tmp_path / name)
    spark.createDataFrame([(*r, *["x"] * (width - len(r))) for r in rows], schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def text(rng, n, letters="abcde"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(4, 8))) for _ in range(n))


def documents():
    rng = random.Random(3)
    rows = [(i, text(rng, rng.randint(1, 120)), f"s{i % 3}", "en") for i in range(60)]
    rows += [(100, None, "s1", None), (101, "", None, "en"), (102, " \n\t", "", "fr"), (None, rows[3][1], None, "en"), (None, None, None, None)]
    rows += [(103, rows[5][1], "s2", "en"), (103, rows[5][1], "s2", "en"), (103, rows[5][1], "s0", "en"), (1, rows[1][1], "s1", "en")]
    rows += [(104, "SHOUT " * 60, "s1", "en"), (105, text(rng, 60) + " #", "s1", "de"), (106, text(rng, 40_000), "s0", "en"), (107, "x" * 20_000, "s0", "en")]
    return rows


def labels():
    rows = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 60, 2)]
    return rows + [(0, 1, 0), (103, 1, 1), (None, 1, 1), (104, None, None), (9999, 1, 1)]


# filter audit


def audit_brute(rows, marks):
    words = re.compile(r"[^\x20\x09-\x0D]+")
    smallest = {}
    for i, t, *_ in rows:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    good = {i for i, q, _ in marks if i is not None and q == 1}
    toxic = {i for i, _, x in marks if i is not None and x == 1}
    docs = []
    for i, t, part, *_ in rows:
        t = t or ""
        w = words.findall(t)
        caps = sum("A" <= c <= "Z" for c in t)
        fails = "".join(
            f
            for f, bad in zip(
                "ABCDE",
                (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * caps > 5 * len(t), any(c in "#$%&*|" for c in t), i is not None and smallest[t] < i),
                strict=True,
            )
            if bad
        )
        docs.append((part or "", fails, i in good, i in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                failing = [d for d in mine if f in d[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(failing) - len(gone), sum(d[1] == f for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def test_filter_audit_equals_brute_force(spark, tmp_path):
    docs, marks = frame(spark, tmp_path, "d", documents(), SCHEMA), frame(spark, tmp_path, "l", labels(), LABELS)
    got = {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in filter_audit.audit(docs, marks).collect()}
    assert got == audit_brute(documents(), labels())


def test_filter_audit_of_no_documents_and_of_no_labels(spark, tmp_path):
    none, docs = frame(spark, tmp_path, "n", [], SCHEMA), frame(spark, tmp_path, "d", documents()[:4], SCHEMA)
    marks = frame(spark, tmp_path, "l", [], LABELS)
    assert filter_audit.audit(none, marks).count() == 0
    rows = filter_audit.audit(docs, marks).collect()
    assert len(rows) == 600 * 3 and all(r["good_lost"] == r["toxic_lost"] == 0 for r in rows)


def test_lehmer_intervals_are_the_removal_steps_of_every_order():
    orders = ["".join(p) for p in itertools.permutations("ABCDE")]
    assert [filter_audit.lehmer_rank(o) for o in orders] == list(range(120))
    found = {}
    for mask, step, lo, hi in filter_audit.removal_intervals():
        for rank in range(lo, hi):
            assert (mask, rank) not in found
            found[mask, rank] = step
    for mask in range(1, 32):
        fails = {f for i, f in enumerate("ABCDE") if mask >> i & 1}
        for rank, order in enumerate(orders):
            assert found[mask, rank] == next(k for k, f in enumerate(order, 1) if f in fails)


# spelling variants


def variants_brute(rows, min_count=3):
    run, counts = re.compile("[A-Za-zÀ-ÿ]+"), Counter()
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for i, t, *_ in rows:
        for w in run.findall(t or ""):
            w = w.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= min_count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    links = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(links[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n[w], len(links[w]), n[form[w]] if form[w] else None) for w in n}


@pytest.fixture(scope="module")
def spelled():
    rng = random.Random(9)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(5, 8))) for _ in range(25)]
    rows = [(i, " ".join(rng.choice(base[: rng.randint(1, 25)]).upper() if rng.random() < 0.1 else rng.choice(base) for _ in range(80)), "s", "en") for i in range(60)]
    typos = [b[:k] + rng.choice("abcü") + b[k + rng.randint(0, 1) :] for b in base for k in (0, 2, 4)]
    rows += [(200 + i, " ".join([t] * rng.randint(1, 6)), "s", "en") for i, t in enumerate(typos)]
    long_run = "".join(rng.choice("ab") for _ in range(3000))
    rows += [(400 + i, long_run + ("" if i < 4 else "a"), "s", "en") for i in range(8)]
    return rows + documents()[:20] + [(None, "abbaé abbaé abbaa", None, None), (500, None, None, None), (501, "", None, None), (400, long_run, "s", "en")]


@pytest.mark.parametrize("region", [8192, 8])
def test_spelling_variants_equal_brute_force(spark, tmp_path, spelled, region):
    docs = frame(spark, tmp_path, "d", spelled, SCHEMA)
    rows = spelling.group_variants(docs, region=region).collect()
    got = {r["word"]: tuple(r)[1:] for r in rows}
    want = variants_brute(spelled)
    assert len(rows) == len(got) and got == want
    assert any(v[1] != v[0] and v[0] for v in want.values()) and any(len(w) > 2000 and v[3] for w, v in want.items())


def test_words_of_the_same_letters_are_sliced(spark):
    """Anagrams cannot be split by letter counts: their region is cut by hash and loses no pair."""
    anagrams = ["".join(p) for p in itertools.permutations("abcdef")]
    near = [a[:2] + "g" + a[3:] for a in anagrams[:40]] + [a + "h" for a in anagrams[:30]]
    words = spark.createDataFrame([(w, 3) for w in anagrams + near], "word string, n long")
    got = {frozenset((r["a"], r["b"])) for r in spelling.near_pairs(words, region=50).collect()}
    pairs = spelling.near_pairs(words, region=50)
    assert pairs.count() == len(got)
    want = set()
    for a, b in itertools.combinations(anagrams + near, 2):
        if len(a) == len(b):
            close = sum(x != y for x, y in zip(a, b, strict=True)) == 1
        else:
            s, t = sorted((a, b), key=len)
            close = any(t[:i] + t[i + 1 :] == s for i in range(len(t)))
        if close:
            want.add(frozenset((a, b)))
    assert got == want


def test_spelling_of_no_documents(spark, tmp_path):
    assert spelling.group_variants(frame(spark, tmp_path, "n", [], SCHEMA)).count() == 0


# language CRF

VOCABULARY = {
    "en": "the and with house there thing water which through night".split(),
    "fr": "le et avec maison là chose eau quelle à travers nuit".split(),
    "de": "der und mit haus dort ding wasser welche durch nacht".split(),
}


def prose(rng, lang, n):
    return " ".join(rng.choice(VOCABULARY[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def language_docs(spark, tmp_path_factory):
    rng = random.Random(1)
    rows = [(i, prose(rng, lang, rng.randint(8, 60)), "s", lang) for i, lang in enumerate(itertools.islice(itertools.cycle(VOCABULARY), 150))]
    rows += [(900, None, "s", "en"), (901, "", "s", "fr"), (902, "123 !? ² 4", "s", "de"), (None, prose(rng, "fr", 20), None, None)]
    rows += [(903, prose(rng, "de", 20), "s", None), (903, prose(rng, "de", 20), "s", None), (904, prose(rng, "en", 400_000), "s", "en"), (905, "a" * 50_000, "s", "en")]
    return frame(spark, tmp_path_factory.mktemp("lang"), "d", rows, SCHEMA)


@pytest.fixture(scope="module")
def language_model(language_docs):
    return language_crf.sample_model(language_docs)


def test_held_out_languages_are_found(language_docs, language_model):
    rows = language_crf.predict(language_docs, language_model).collect()
    lang = {r["doc_id"]: r["lang"] for r in language_docs.collect()}
    assert len(rows) == len(language_docs.collect())
    for r in rows:
        assert r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
    plain = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 900 and r["held_out"]]
    assert len(plain) > 15 and all(r["lang_pred"] == lang[r["doc_id"]] for r in plain)
    by_id = {r["doc_id"]: r for r in rows}
    assert all((by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0) for i in (900, 901, 902))
    assert by_id[None]["lang_pred"] == "fr" and by_id[903]["lang_pred"] == "de" and by_id[904]["lang_pred"] == "en"


def test_code_switched_text_is_labelled_word_by_word(spark, language_model):
    rng = random.Random(4)
    parts = [("en", 12), ("fr", 9), ("de", 15), ("en", 7)]
    docs = spark.createDataFrame([(1, " ".join(prose(rng, lang, n) for lang, n in parts)), (2, None)], "doc_id long, text string")
    runs = {r["doc_id"]: [(x["lang"], x["words"]) for x in r["runs"]] for r in language_crf.language_runs(docs, language_model).collect()}
    # vocabularies of several words ("à travers") and of names shared by languages leave the borders near, not always exact
    assert [lang for lang, _ in runs[1]] == [lang for lang, _ in parts] and runs[2] == []


def test_forward_backward_equals_the_sum_over_all_paths():
    rng = np.random.default_rng(2)
    n, k = 6, 3
    scores, transitions, start = rng.normal(size=(n, k)), rng.normal(size=(k, k)), rng.normal(size=k)
    first = np.array([True, False, False, True, False, False])
    want = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        total = sum(scores[t, path[t]] + (start[path[t]] if first[t] else transitions[path[t - 1], path[t]]) for t in range(n))
        for t in range(n):
            want[t, path[t]] += np.exp(total)
    want /= want.sum(axis=1, keepdims=True)
    assert np.allclose(language_crf.posteriors(scores, first, transitions, start), want)


def test_blocks_do_not_change_posteriors(monkeypatch):
    rng = np.random.default_rng(5)
    n, k = 1000, 4
    scores, transitions, start = rng.normal(size=(n, k)) * 3, rng.normal(size=(k, k)), rng.normal(size=k)
    first = rng.random(n) < 0.01
    first[0] = True
    whole = language_crf.posteriors(scores, first, transitions, start)
    for block in (1, 7, 2000):
        monkeypatch.setattr(language_crf, "BLOCK", block)
        assert np.allclose(language_crf.posteriors(scores, first, transitions, start), whole)


def test_learned_gradient_agrees_with_a_finite_difference():
    """Expected transitions are the derivative of the log partition function."""
    rng = np.random.default_rng(8)
    e, a, s = np.exp(rng.normal(size=(2, 5, 3))), rng.normal(size=(3, 3)), np.exp(rng.normal(size=3))
    first = np.zeros((2, 5), bool)
    first[:, 0] = True

    def log_z(t):
        total = 0.0
        for row in e:
            alpha = s * row[0]
            for x in row[1:]:
                alpha = (alpha @ np.exp(t)) * x
            total += np.log(alpha.sum())
        return total

    ones = np.ones((2, 3))
    expected = language_crf.walk(e, first, np.exp(a), s, ones, ones, pairs=True)[1]
    for i, j in itertools.product(range(3), repeat=2):
        step = np.zeros((3, 3))
        step[i, j] = 1e-5
        assert abs((log_z(a + step) - log_z(a - step)) / 2e-5 - expected[i, j]) < 1e-6


def test_language_of_nothing_learned_and_of_no_documents(spark, tmp_path):
    docs = frame(spark, tmp_path, "u", [(1, "some words", "s", None), (2, None, "s", None)], SCHEMA)
    model = language_crf.sample_model(docs)
    assert {(r["lang_pred"], r["score"]) for r in language_crf.predict(docs, model).collect()} == {("und", 0.0)}
    none = frame(spark, tmp_path, "n", [], SCHEMA)
    assert language_crf.predict(none, language_crf.sample_model(none)).count() == 0
