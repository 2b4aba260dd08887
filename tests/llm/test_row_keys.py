"""Row keys do not depend on how files are cut into tasks; nor do the operators that join by them."""

import random

import pytest
from pyspark.sql import functions as F

from kestrel.llm import common, exact_dedup, mixing, simhash, suffix_dedup, toxicity

FEW, MANY = "2", "24"


@pytest.fixture
def docs(spark, tmp_path):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randint(0, 30)) for _ in range(rng.randint(20, 60))) for _ in range(60)]
    rows = [(i, texts[i % 45] + (" tail" if i % 7 == 0 else ""), f"s{i % 3}", "x", "x") for i in range(120)]
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, source string, _row string, _file string").repartition(12).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def splits(spark):
    """Sets the least number of file splits, as a change of the number of cores does."""
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield lambda n: spark.conf.set("spark.sql.files.minPartitionNum", n)
    spark.conf.unset("spark.sql.files.minPartitionNum")
    spark.conf.set("spark.sql.files.openCostInBytes", before)


def test_keys_are_unique_and_stay(docs, splits):
    def keys():
        return {r["_row"]: r["doc_id"] for r in common.with_row_key(docs, "_row", doc_id=F.col("doc_id")).collect()}

    splits(FEW)
    cut, first = docs.select("text").rdd.getNumPartitions(), keys()
    splits(MANY)
    assert docs.select("text").rdd.getNumPartitions() != cut
    assert keys() == first and len(first) == 120


def test_rows_that_come_from_no_file_are_written_first(spark):
    made = spark.range(50).groupBy((F.col("id") % 10).alias("doc_id")).agg(F.count("*").alias("n"))
    kept = common.stored(made)
    keys = common.with_row_key(kept, "k", doc_id=F.col("doc_id")).collect()
    assert len({r["k"] for r in keys}) == 10


LABELS = [(i, 1, int(i % 9 == 0)) for i in range(120)]
OPERATORS = {
    "exact": lambda d, _: exact_dedup.drop_duplicates(d).select("doc_id"),
    "simhash": lambda d, _: simhash.drop_near_duplicates(d).select("doc_id"),
    "mixing": lambda d, _: mixing.mixed_documents(d).select("doc_id"),
    "toxicity": lambda d, labels: toxicity.drop_toxic(d, labels).select("doc_id"),
    "suffix": lambda d, _: suffix_dedup.remove_repeats(d).select("doc_id", "n_removed", "kept_sha256"),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_results_stay_when_splits_change_between_jobs(spark, docs, splits, monkeypatch, name):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    splits(FEW)
    want = sorted(map(tuple, OPERATORS[name](docs, labels).collect()))
    module = {"exact": exact_dedup, "simhash": simhash, "mixing": mixing, "toxicity": toxicity, "suffix": suffix_dedup}[name]
    turn = iter([MANY, FEW] * 100)

    def changing(df, step):
        out = common.materialise(df, step)
        splits(next(turn))
        return out

    if hasattr(module, "materialise"):
        monkeypatch.setattr(module, "materialise", changing)
    found = OPERATORS[name](docs, labels)
    splits(MANY)
    assert sorted(map(tuple, found.collect())) == want
