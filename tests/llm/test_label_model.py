"""The label model against enumeration, and a sample that is weighted back to the labelled shares."""

import numpy as np

from kestrel.llm import toxicity


def test_posterior_equals_enumeration_of_the_hidden_label():
    """P(y | votes) by summing the joint over both labels; a voter that does not fire says nothing, the last fires where none does."""
    rng = np.random.default_rng(4)
    hidden = rng.random(400) < 0.2
    chance = np.array([[0.02, 0.01, 0.03, 0.05], [0.5, 0.4, 0.6, 0.3]])
    votes = rng.random((400, 4)) < chance[hidden.astype(int)]
    start = np.where(votes.any(axis=1), 0.9, 0.001)
    post, fires, corr = toxicity.label_model(votes, start, 0.2)
    linked = corr > toxicity.MIN_CORRELATION
    assert not (linked & ~np.eye(5, dtype=bool))[:4, :4].any()  # no groups: the voters are independent
    for i, row in enumerate(np.column_stack([votes, ~votes.any(axis=1)])):
        joint = [(0.8, 0.2)[y] * np.prod(fires[y][row]) for y in (0, 1)]
        assert abs(post[i] - joint[1] / sum(joint)) < 1e-9
    # nearly as often right as the rule that knows the true chances
    odds = np.log(0.2 / 0.8) + (votes * np.log(chance[1] / chance[0]) + ~votes * np.log((1 - chance[1]) / (1 - chance[0]))).sum(axis=1)
    assert ((post > 0.5) == hidden).mean() >= ((odds > 0) == hidden).mean() - 0.03


def test_weights_restore_the_share_of_each_label():
    """A sample with one clean document for ten gives the model of the whole: same prior, same verdicts."""
    rng = np.random.default_rng(1)
    plain = [f"w{i}" for i in range(50)]

    def text(bad):
        words = list(rng.choice(plain, 20))
        return " ".join(words + ([f"slur{rng.integers(3)}", f"slur{rng.integers(3)}"] if bad else []))

    clean, toxic = [text(False) for _ in range(1500)], [text(True) for _ in range(150)]
    whole = toxicity.fit(clean + toxic, [0] * 1500 + [1] * 150)
    part = toxicity.fit(clean[:150] + toxic, [0] * 150 + [1] * 150, (10.0, 1.0))
    flat = toxicity.fit(clean[:150] + toxic, [0] * 150 + [1] * 150)
    score = lambda m, t: 1 / (1 + np.exp(-(m.bias + sum(m.weights.get(f, 0) for f in toxicity.features(t)))))
    assert abs(part.bias - whole.bias) < abs(flat.bias - whole.bias)
    for m in (whole, part):
        assert all(score(m, t) < 0.7 for t in clean[150:400]) and all(score(m, t) >= 0.7 for t in toxic)


def test_no_telling_entry_is_left_out():
    """Three hundred slurs, more than the old list held; entries of the same documents become one voter."""
    texts = [f"slur{i // 24:04d}x plain words here w{i}" for i in range(7200)] + [f"plain words here v{i}" for i in range(7200)]
    sample = toxicity.Sample.of(texts, [1] * 7200 + [0] * 7200)
    entries = [sample.names[k] for k in toxicity.lexicon(sample)]
    assert len([e for e in entries if e.startswith("=slur")]) == 300
    assert len({sample.names.index(e) for e in entries}) == len(entries)


def test_a_score_of_exactly_the_threshold_is_toxic(spark, tmp_path):
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame([(1, "x"), (2, None)], "doc_id long, text string").write.parquet(path)
    model = toxicity.Model(0.0, {})
    rows = toxicity.score(spark.read.parquet(path), model, threshold=0.5).collect()
    assert {(r["score"], r["predicted"]) for r in rows} == {(0.5, 1)}


def test_the_sample_comes_without_texts_and_rare_features_and_gives_the_same_model(spark):
    texts = [f"wort{k} shared{k % 7} {'you are an idiot scum' if k % 5 == 0 else 'kind words'} {k % 40}" for k in range(400)] + ["", "die!!!"]
    rows = [(k, t, int(k % 5 == 0)) for k, t in enumerate(texts)]
    chosen = spark.createDataFrame(rows, "_d long, t string, _toxic int")
    sizes = {0: sum(not r[2] for r in rows), 1: sum(r[2] for r in rows)}
    whole, part = toxicity.Sample.of(texts, [r[2] for r in rows]), toxicity.sample_of(chosen.repartition(5), sizes)
    assert len(part.toxic) == len(texts) and len(part.names) < 100 < len(whole.names)
    assert part.names == [whole.names[k] for k in sorted(set(whole.col[np.isin(whole.col, [i for i, c in enumerate(np.bincount(whole.col)) if c >= toxicity.MIN_FIRES or whole.names[i][0] == "~"])].tolist()))]
    a, b = toxicity.fit_sample(whole), toxicity.fit_sample(part)
    assert a.bias == b.bias and a.weights == b.weights and a.voters == b.voters and a.weights


def test_rows_that_share_an_id_are_one_document_of_the_sample(spark):
    docs = spark.createDataFrame([(3, "a b"), (3, "c d"), (5, None), (6, "e f")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1) for k in range(30)], "doc_id long, toxic int")
    assert toxicity.sample_model(docs, labels).weights == {}
    none = toxicity.sample_of(spark.createDataFrame([], "_d long, t string, _toxic int"), {})
    assert len(none.toxic) == 0 and none.names == []
