"""The pipeline's stages one after another on a small table, against their own operators' brute-force results."""

import hashlib
import random

import pytest

pytest.importorskip("public_tokenizers")
import corpus_pipeline  # noqa: E402
from kestrel.llm.common import materialise  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    word = lambda: rng.choice("abcdefghijklm") + rng.choice("opqrstu") + rng.choice("vwxyz") + str(rng.randint(0, 99))
    text = lambda n: " ".join(word() for _ in range(n))
    rows, labels = [], []
    for i in range(300):
        bad = i % 10 == 0
        rows.append((i, text(80) + (" you idiot scum zorkab" if bad else ""), "en", f"s{i % 3}", 0))
        labels.append((i, 1, int(bad)))
    rows += [(1000 + i, rows[i][1], "en", "s0", 0) for i in range(1, 30)]  # exact copies
    rows += [(2000 + i, rows[i][1] + " End", "en", "s1", 0) for i in range(41, 50)]  # near copies
    rows += [(3000, None, None, None, None), (3001, "", "en", "s0", 0), (None, text(50), "en", "s2", 0)]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    return str(path)


def test_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, folder), "test-stage")
        assert docs.columns == columns
        seen[name] = [(r["doc_id"], r["text"]) for r in docs.collect()]
    toxic = {i for i in range(300) if i % 10 == 0}
    ids = {i for i, _ in seen["toxicity"]}
    assert not ids & toxic and len(ids) >= 300 + 29 + 9 + 3 - len(toxic) - 2 - 8
    after = seen["exact dedup"]
    assert len({t or "" for _, t in after}) == len(after) == len({t or "" for _, t in seen["toxicity"]})
    near = {i for i, _ in seen["simhash near-dedup"]}
    assert near <= {i for i, _ in after} and len(near) < len(after)
    mixed = seen["mixing"]
    assert {i for i, _ in mixed} <= near and len(mixed) > len({i for i, _ in mixed})
    out = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["decoded_sha256"]) for r in out) == sorted(
        (i is None, i or 0, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in mixed
    )
