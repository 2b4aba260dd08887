"""Sides that are repeated over salts, or small in their files only, are never broadcast: they would pass whole through the driver (F1, F2)."""

import pytest
from pyspark.sql import functions as F

pytest.importorskip("xxhash")
from kestrel.llm import simhash  # noqa: E402
from kestrel.llm.common import salted_join  # noqa: E402


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_salted_join_does_not_broadcast_what_it_repeats(spark, tmp_path, how):
    big = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d"), (3, "e")], "k long, t string")
    spark.createDataFrame([(1, 10), (None, 20), (2, 30)], "k long, v long").write.parquet(str(tmp_path / "small"))
    small = spark.read.parquet(str(tmp_path / "small"))  # the planner knows that its files are small
    joined = salted_join(big, small, ["k"], ["t"], how)
    assert "Broadcast" not in plan(joined)
    found = {(1, "a"): 10, (1, "b"): 10, (None, "c"): 20, (2, "d"): 30} | ({(3, "e"): None} if how == "left" else {})
    want = [k if how == "left_semi" else (*k, v) for k, v in found.items()]
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(want, key=str)


def test_near_copies_send_no_row_per_document_to_the_driver(spark, tmp_path):
    rows = [(i, f"words number {i % 7} of a text that some have") for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    near = simhash.near_duplicates(docs)
    assert "Broadcast" not in plan(near)
    assert near.where("_row = keep_row").agg(F.countDistinct("component_id")).head()[0] <= 7
