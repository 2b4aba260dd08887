import pytest
from pyspark.sql import functions as F

from kestrel.operators.joins import salts_by_degree, spread_join
from kestrel.session import checkpoint_dir, clear_scratch, cut_lineage, scratch_path
from kestrel.sources import files

TEXTS = [None, "", " ", "  a  ", "a,b", 'say "x"', '"', "line\nbreak", "cr\rlf\r\n", "\\", "\\n", "\\0", "\\e", "\\s", "\\\\n", "\t", "é", "NaN", "null", "#c", "'"]


def test_scratch_lives_under_checkpoint_dir(spark):
    base = checkpoint_dir(spark)
    assert scratch_path(spark, "x").startswith(base.rstrip("/") + "/kestrel-scratch/")


def test_cleared_scratch_is_gone(spark):
    df = cut_lineage(spark.range(5))
    assert df.count() == 5
    clear_scratch(spark)
    with pytest.raises(Exception):  # noqa: B017, PT011 - the file is missing
        df.select(F.sum("id")).collect()


@pytest.mark.parametrize("header", [True, False])
def test_text_survives_csv_exactly(spark, header):
    rows = [(i, t, t, None if i % 2 else 0.5) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "k long, a string, b string, x double")
    path = files.write_features(df, scratch_path(spark, "t-text"), header=header)
    back = files.read_csv(spark, path, df.schema, header=header, encoded=True)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    stream = files.decode_text(spark.read.schema(df.schema).options(**files.csv_options(header, ",")).csv(path))
    assert sorted(map(tuple, stream.collect())) == sorted(rows)


def test_foreign_csv_with_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,text\n1,"two\nlines, ""quoted"""\n2, blank kept \n')
    df = files.read_csv(spark, str(tmp_path), "id int, text string", multi_line=True)
    assert sorted(map(tuple, df.collect())) == [(1, 'two\nlines, "quoted"'), (2, " blank kept ")]


def test_spread_join_deals_a_hot_key(spark):
    big = spark.range(4000).select((F.col("id") % 2 * (F.col("id") % 7)).alias("k"), F.col("id").alias("x"))
    small = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    joined = spread_join(big, small, "k", ["x"], salts=8)
    assert sorted(map(tuple, joined.select("x", "v").collect())) == sorted(map(tuple, big.join(small, "k").select("x", "v").collect()))
    left = spread_join(big, small, "k", ["x"], "left", salts=8)
    assert left.count() == 4000 and left.where("v IS NULL").count() == big.where("k > 4").count()
    # the hot key (k = 0 holds over half) reaches the join by several hash keys
    salts = big.where("k = 0").select(F.pmod(F.xxhash64("x"), F.lit(8)).alias("s")).distinct().count()
    assert salts == 8 and "k#" in spread_join(big, small, "k", ["x"])._jdf.queryExecution().toString()


def test_repeated_side_of_a_spread_join_is_not_broadcast(spark, tmp_path):
    """A table repeated once per salt looks to the planner as small as it was before."""
    spark.range(2000).select(F.col("id").alias("k"), F.lit(1).alias("v")).write.parquet(str(tmp_path / "small"))
    small = spark.read.parquet(str(tmp_path / "small"))
    joined = spread_join(spark.range(4000).select((F.col("id") % 2000).alias("k"), F.col("id").alias("x")), small, "k", ["x"])
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 4000


def test_salts_by_degree_are_those_of_a_count(spark):
    big = spark.range(1000).select(F.when(F.col("id") < 700, 0).otherwise(F.col("id")).alias("k"))
    counts = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert list(map(tuple, salts_by_degree(counts, "k", "n", 100).collect())) == [(0, 7)]
    assert salts_by_degree(counts, "k", "n", 700) is None
