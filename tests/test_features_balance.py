import pytest
from pyspark.sql import functions as F

from kestrel.operators import balance, evaluate, features


def test_epoch_and_duration(spark):
    rows = [
        ("2020-01-01 00:00:00", "2020-01-01 00:01:40"),
        ("2020-01-01 00:00:00.5", "2020-01-01 00:00:10"),
        ("garbage", None),
        ("2020-01-02 00:00:00", "2020-01-01 00:00:00"),
    ]
    df = spark.createDataFrame(rows, "s string, e string")
    out = features.add_duration(features.add_epoch_seconds(df, ["s", "e"]), "sVec", "eVec").collect()
    assert [r["Duration"] for r in out] == [100, None, None, -86400]


def test_parse_vector_and_expand(spark):
    df = spark.createDataFrame([("[0.1, -2]",), ("bad",), (None,), ("[]",), ("[3]",)], "v string")
    out = features.expand_array(features.add_parsed_vector(df, "v"), "v", 2).collect()
    assert [tuple(r) for r in out] == [(0.1, -2.0), (None, None), (None, None), (None, None), (3.0, None)]


def test_tokens_keep_empty_token(spark):
    df = spark.createDataFrame([("a  b",)], "t string")
    assert features.add_tokens(df, "t").head()[0] == ["a", "", "b"]


def test_string_index_matches_sql_rank(spark):
    df = spark.createDataFrame([(v,) for v in "ccbbbaad"], "v string")
    out, model = features.string_index(df, ["v"])
    assert model.labelsArray[0] == ["b", "a", "c", "d"]
    sql = df.groupBy("v").count().selectExpr("v", "row_number() over (order by count desc, v) - 1 as i")
    m = {r["v"]: r["i"] for r in sql.collect()}
    assert all(r["vVec"] == m[r["v"]] for r in out.collect())


@pytest.mark.parametrize("small", [True, False])
def test_label_index_handles_gaps_unseen_values_and_the_way_back(spark, monkeypatch, small):
    if not small:  # the way of long label lists: frequent values broadcast, the others joined
        monkeypatch.setattr(features, "BROADCAST_LABELS", 0)
        monkeypatch.setattr(features, "ROWS_PER_SALT", 2)
    df = spark.createDataFrame([(i, v, w) for i, (v, w) in enumerate(zip("ccbbbaad", "xyxyxyxy"))], "id long, v string, w string")
    out, index = features.string_index(df, ["v", "w"])
    rank = {"b": 0.0, "a": 1.0, "c": 2.0, "d": 3.0}
    assert out.columns == ["id", "v", "w", "vVec", "wVec"]
    assert {(r["id"], r["vVec"], r["wVec"]) for r in out.collect()} == {(i, rank[v], float(w == "y")) for i, (v, w) in enumerate(zip("ccbbbaad", "xyxyxyxy"))}
    back = index.inverse(out.drop("v"), "v", "text")
    assert {(r["id"], r["text"]) for r in back.collect()} == set(enumerate("ccbbbaad"))
    new = spark.createDataFrame([(1, None, "x"), (2, "new", "y"), (3, "a", "x")], "id long, v string, w string")
    index.handle_invalid = "keep"
    assert {(r["id"], r["vVec"]) for r in index.transform(new).collect()} == {(1, 4.0), (2, 4.0), (3, 1.0)}
    index.handle_invalid = "skip"
    assert [r["id"] for r in index.transform(new).collect()] == [3]
    index.handle_invalid = "error"
    with pytest.raises(Exception, match="NULL or a value"):
        index.transform(new).collect()


def test_label_index_of_many_values_in_many_ranges(spark):
    """Dense, without gaps or doubles, in the order of SQL, however the ranges fall."""
    df = spark.range(5000).selectExpr("id", "concat('k', cast(id * id % 1777 as string)) as v")
    out, index = features.string_index(df, ["v"])
    assert index.labels.rdd.getNumPartitions() > 0
    sql = df.groupBy("v").count().selectExpr("v", "row_number() over (order by count desc, v) - 1 as i")
    want = {r["v"]: r["i"] for r in sql.collect()}
    assert {r["value"]: r["label_index"] for r in index.labels.collect()} == want
    assert out.count() == 5000 and all(want[r["v"]] == r["vVec"] for r in out.collect())


def test_assemble_refuses_label_as_feature(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, y double")
    with pytest.raises(ValueError):
        features.assemble(df, ["a", "y"], label="y")
    assert features.assemble(df, ["a"], label="y").columns == ["features", "label"]


def test_hash_split_disjoint_complete_stable(spark):
    df = spark.range(0, 2000).withColumn("k2", F.col("id") % 7)
    tr, te = balance.hash_split(df, ["id", "k2"], 0.7)
    a, b = {r[0] for r in tr.collect()}, {r[0] for r in te.collect()}
    assert not a & b and len(a | b) == 2000
    assert 0.6 < len(a) / 2000 < 0.8
    tr2, _ = balance.hash_split(df.repartition(5), ["id", "k2"], 0.7)
    assert {r[0] for r in tr2.collect()} == a


def test_replicate_and_oversample(spark):
    df = spark.createDataFrame([(i, 0) for i in range(10)] + [(100 + i, 1) for i in range(3)] + [(999, None)], "id int, label int")
    assert balance.replicate(df, 3).count() == 3 * df.count()
    over = balance.oversample(df, "label")
    counts = {r[0]: r["n"] for r in balance.label_counts(over, "label").collect()}
    assert counts == {0: 10, 1: 3 * (10 // 3 + 1)}
    assert over.where("label = 0").select("id").distinct().count() == 10


def test_oversample_single_class_raises(spark):
    df = spark.createDataFrame([(1, 0), (2, 0)], "id int, label int")
    with pytest.raises(ValueError):
        balance.oversample(df, "label")


def test_weighted_metrics_agree_with_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rows = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (2.0, 0.0), (2.0, 2.0), (2.0, 2.0), (1.0, 2.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    got = evaluate.weighted_metrics(df).head()
    for name, metric in [("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                         ("weighted_recall", "weightedRecall"), ("weighted_f1", "f1")]:
        exp = MulticlassClassificationEvaluator(metricName=metric).evaluate(df)
        assert abs(got[name] - exp) < 1e-12, name
    assert abs(got["weighted_recall"] - got["accuracy"]) < 1e-12
