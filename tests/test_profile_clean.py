import math

from pyspark.sql import functions as F

from kestrel.operators import clean, profile

NAN = float("nan")


def missing_frame(spark):
    rows = [
        (1, None, "a", "True"),
        (2, NAN, "", "NaN"),
        (3, 1.5, None, None),
        (4, 2.5, "NaN", "x"),
    ]
    return spark.createDataFrame(rows, "id int, x double, t string, b string")


def test_missing_counts_null_and_nan(spark):
    got = {r["column_name"]: r["n_missing"] for r in profile.missing_counts(missing_frame(spark)).collect()}
    # NaN counts for floating columns only; empty text and the text 'NaN' are values
    assert got == {"id": 0, "x": 2, "t": 1, "b": 1}


def test_missing_counts_sorted_desc(spark):
    rows = profile.missing_counts(missing_frame(spark)).collect()
    assert [r["n_missing"] for r in rows] == sorted([r["n_missing"] for r in rows], reverse=True)


def test_shape_and_schema(spark):
    df = missing_frame(spark)
    assert profile.shape(df).head().asDict() == {"n_rows": 4, "n_cols": 4}
    names = [r["column_name"] for r in profile.schema_table(df).orderBy("position").collect()]
    assert names == ["id", "x", "t", "b"]


def test_modes_ignore_null_and_break_ties_by_value(spark):
    df = spark.createDataFrame([(None,), (None,), (None,), ("b",), ("a",), ("b",), ("a",)], "v string")
    r = profile.modes(df, ["v"]).head()
    assert (r["mode"], r["n"]) == ("a", 2)


def test_summary_exact_percentiles(spark):
    df = spark.range(1, 101).select(F.col("id").cast("double").alias("v"))
    r = profile.summary(df).head()
    assert (r["count"], r["mean"], r["min"], r["max"]) == (100, 50.5, 1.0, 100.0)
    assert (r["p25"], r["p50"], r["p75"]) == (25.0, 50.0, 75.0)


def test_percentiles_are_exact_over_a_million_rows_with_ties_and_gaps(spark):
    n = 1_200_000
    df = spark.range(n).select(
        F.when(F.col("id") % 10 != 0, ((F.col("id") * 7919) % 1_000_003).cast("double")).alias("v"), (F.col("id") % 3).cast("int").alias("w")
    )
    got = {(r["column_name"], r["p"]): r["value"] for r in profile.exact_percentiles(df, ["v", "w"], (0.0, 0.25, 0.5, 0.999, 1.0)).collect()}
    values = sorted(float((i * 7919) % 1_000_003) for i in range(n) if i % 10)
    small = sorted(float(i % 3) for i in range(n))
    for p in (0.0, 0.25, 0.5, 0.999, 1.0):
        assert got[("v", p)] == values[max(1, math.ceil(p * len(values))) - 1]
        assert got[("w", p)] == small[max(1, math.ceil(p * n)) - 1]


def test_summary_of_text_and_of_empty_columns(spark):
    df = spark.createDataFrame([("b", None), (None, None), ("a", None)], "s string, x double")
    assert [tuple(r) for r in profile.summary_text(df).collect()] == [("s", 2, "a", "b")]
    r = profile.summary(df).head()
    assert (r["count"], r["mean"], r["p50"]) == (0, None, None)


def test_correlation_skips_rows_with_gaps(spark):
    rows = [(float(i), float(i * i % 7), None if i % 4 == 0 else float(i % 5)) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    m = {(r["col_a"], r["col_b"]): r["corr"] for r in profile.correlation(df).collect()}
    want = df.agg(F.corr("a", "b").alias("ab"), F.corr("a", "c").alias("ac")).head()
    assert math.isclose(m[("a", "b")], want["ab"], rel_tol=1e-9) and math.isclose(m[("c", "a")], want["ac"], rel_tol=1e-9)
    assert len(m) == 9


def test_mean_fill_of_integers_is_not_truncated(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert sorted(r["k"] for r in clean.impute_mean(df, ["k"]).collect()) == [1.0, 1.5, 2.0]


def test_correlation_symmetric_unit_diagonal(spark):
    df = spark.range(0, 50).select(
        F.col("id").cast("double").alias("a"), (F.col("id") * F.col("id")).cast("double").alias("b"), (-F.col("id")).alias("c")
    )
    m = {(r["col_a"], r["col_b"]): r["corr"] for r in profile.correlation(df).collect()}
    for a in "abc":
        assert math.isclose(m[(a, a)], 1.0, rel_tol=1e-12)
        for b in "abc":
            assert math.isclose(m[(a, b)], m[(b, a)], rel_tol=1e-12)
    assert math.isclose(m[("a", "c")], -1.0, rel_tol=1e-12)
    sp = {(r["col_a"], r["col_b"]): r["corr"] for r in profile.correlation(df, method="spearman").collect()}
    assert math.isclose(sp[("a", "b")], 1.0, rel_tol=1e-9)


def test_value_counts(spark):
    df = spark.createDataFrame([("x", 1), ("y", 1), ("x", 2)], "s string, k int")
    got = {(r["column_name"], r["value"]): r["n"] for r in profile.value_counts(df, ["s", "k"]).collect()}
    assert got == {("s", "x"): 2, ("s", "y"): 1, ("k", "1"): 2, ("k", "2"): 1}


def test_bool_text_and_to_double(spark):
    df = spark.createDataFrame([("True",), ("False",), ("1",), ("true",), (None,), ("x",)], "b string")
    got = [r[0] for r in clean.cast_bool_text(df, ["b"]).collect()]
    assert got == [1, 0, 1, None, None, None]
    d = spark.createDataFrame([("1.5",), ("bad",), ("",), (None,)], "s string")
    assert [r[0] for r in clean.cast_to_double(d, ["s"]).collect()] == [1.5, None, None, None]


def test_drop_columns_case_insensitive_missing_ignored(spark):
    df = missing_frame(spark)
    assert clean.drop_columns(df, ["X", "nope", "B"]).columns == ["id", "t"]


def test_drop_missing_rows_drops_nan(spark):
    assert clean.drop_missing_rows(missing_frame(spark)).count() == 1


def test_impute_mean_fills_null_keeps_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (NAN,)], "x double")
    got = [r[0] for r in clean.impute_mean(df, ["x"]).collect()]
    assert got[:3] == [1.0, 2.0, 3.0] and math.isnan(got[3])
    got = [r[0] for r in clean.impute_mean(df, ["x"], overrides={"x": 9.0}).collect()]
    assert got[1] == 9.0


def test_impute_mode(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "s string")
    assert [r[0] for r in clean.impute_mode(df, ["s"]).collect()] == ["a", "b", "b", "b"]


def test_spearman_leaves_out_gaps_pair_by_pair(spark):
    import random

    import pandas as pd

    rng = random.Random(4)
    gap = lambda x, p: None if rng.random() < p else x
    rows = [(gap(float(rng.randint(0, 5)), 0.2), gap(rng.random(), 0.3), gap(float(rng.randint(0, 40)), 0.1), 1.0) for _ in range(300)]
    rows.append((float("nan"), 1.0, 2.0, 1.0))
    df = spark.createDataFrame(rows, "a double, b double, c double, same double")
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in profile.correlation(df, method="spearman").collect()}
    assert len(got) == 16
    frame = pd.DataFrame(rows, columns=["a", "b", "c", "same"], dtype=float)
    for x in "abc":
        for y in "abc":
            part = frame[[x, y]].dropna() if x != y else frame[[x]].dropna()
            assert abs(got[x, y] - part[x].rank().corr(part[y].rank())) < 1e-9
        assert got[x, "same"] is None
