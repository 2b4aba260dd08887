import os

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from kestrel.operators import evaluate, models
from kestrel.plans import catalog
from kestrel.session import scratch_path
from kestrel.sources import files
from kestrel.streaming import stream

import __spark_entry__ as E


def separable(spark, n=400):
    df = spark.range(n).select(
        (F.col("id") % 2).cast("double").alias("label"),
        ((F.col("id") % 2) * 3 + (F.col("id") % 5) / 10).cast("double").alias("a"),
        (F.col("id") % 3).cast("double").alias("b"),
    )
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


def test_logistic_beats_majority_and_save_load(spark):
    df = separable(spark)
    m = models.logistic(df, 50, 0.0, 0.0)
    acc = evaluate.accuracy(models.score(m, df)).head()["accuracy"]
    assert acc > 0.9
    path = models.save_model(m, scratch_path(spark, "t-model"))
    back = models.load_model(path, "LogisticRegressionModel")
    a = [r[0] for r in models.score(m, df).select("prediction").collect()]
    b = [r[0] for r in models.score(back, df).select("prediction").collect()]
    assert a == b


def test_perceptron_layers_from_data(spark):
    m = models.perceptron(separable(spark), hidden=(4,), max_iter=20)
    assert list(m.getLayers()) == [2, 4, 2]


def test_forest_importances_named(spark):
    df = separable(spark)
    m = models.forest(df, max_depth=4, num_trees=5)
    imp = {r["feature"]: r["importance"] for r in models.importances(m, models.feature_names(df)).collect()}
    assert set(imp) == {"a", "b"} and abs(sum(imp.values()) - 1.0) < 1e-9


def test_stream_counts_equal_batch(spark):
    ev = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 3).cast("string").alias("g"))
    src = files.write_features(ev.repartition(3), scratch_path(spark, "t-src"), header=False)
    out = scratch_path(spark, "t-out")
    s = stream.read_csv_stream(spark, src, "k long, g string", max_files_per_trigger=1)

    def per_batch(b, epoch):
        stream.write_epoch(b.groupBy("g").count(), epoch, out)

    stream.run_batches(s, per_batch, scratch_path(spark, "t-ckpt"))
    res = spark.read.parquet(out)
    assert res.select("epoch_id").distinct().count() >= 3
    got = {r["g"]: r["n"] for r in res.groupBy("g").agg(F.sum("count").alias("n")).collect()}
    assert got == {"0": 100, "1": 100, "2": 100}


def test_train_per_batch_guards_single_class(spark):
    df = spark.range(50).select(F.lit(1.0).alias("label"), F.col("id").cast("double").alias("x"))
    src = files.write_features(df.coalesce(1), scratch_path(spark, "t-one"), header=False)
    out = scratch_path(spark, "t-metrics")
    s = stream.read_csv_stream(spark, src, "label double, x double")
    stream.run_batches(s, stream.train_per_batch(["x"], out), scratch_path(spark, "t-ckpt2"))
    r = spark.read.parquet(out).head()
    assert r["accuracy"] is None and r["n_train"] + r["n_test"] == 50


def test_entry_contract():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)


def test_entry_runs(spark):
    if not os.path.isdir(E.SMOKE_DIR):
        pytest.skip("no data folder")
    rows = E.entry(spark).collect()
    assert len(rows) == 1 and 0.0 <= rows[0]["accuracy"] <= 1.0


def test_encoded_schema_stream_keeps_first_row_of_each_file(spark):
    from kestrel.sources.schemas import ENCODED_ACCIDENTS_SCHEMA, ACCIDENTS_SCHEMA, NODE_FEATURES_SCHEMA

    assert len(ACCIDENTS_SCHEMA) == 49 and len(ENCODED_ACCIDENTS_SCHEMA) == 33 and len(NODE_FEATURES_SCHEMA) == 15
    cols = [F.lit(float(i)).alias(f.name) for i, f in enumerate(ENCODED_ACCIDENTS_SCHEMA.fields)]
    df = spark.range(10).select(*cols)
    src = files.write_features(df.repartition(2), scratch_path(spark, "t-enc"), header=False)
    out = scratch_path(spark, "t-enc-out")
    s = stream.prepare(stream.read_csv_stream(spark, src, ENCODED_ACCIDENTS_SCHEMA, header=False), {"Severity": "label"})
    stream.run_batches(s, lambda b, e: stream.write_epoch(b, e, out), scratch_path(spark, "t-enc-ckpt"))
    back = spark.read.parquet(out)
    assert back.count() == 10 and "label" in back.columns


def test_accidents_csv_scan_by_position(spark, tmp_path):
    from kestrel.sources.schemas import ACCIDENTS_SCHEMA

    header = ",".join(f.name for f in ACCIDENTS_SCHEMA.fields)
    vals = ["x" if f.dataType.simpleString() == "string" else "1" for f in ACCIDENTS_SCHEMA.fields]
    p = tmp_path / "acc.csv"
    p.write_text(header + "\n" + ",".join(vals) + "\n")
    df = files.read_csv(spark, str(p), ACCIDENTS_SCHEMA, header=True)
    r = df.head()
    assert r["Severity"] == 1 and r["Distance(mi)"] == 1.0 and r["ID"] == "x"


def test_unfinished_stream_raises(spark):
    import time

    src = files.write_features(spark.range(40).repartition(4), scratch_path(spark, "t-slow"), header=False)
    s = stream.read_csv_stream(spark, src, "id long", max_files_per_trigger=1)
    ckpt = scratch_path(spark, "t-slow-ckpt")
    out = scratch_path(spark, "t-slow-out")

    def slow(batch, epoch):
        time.sleep(1.5)
        stream.write_epoch(batch, epoch, out)

    with pytest.raises(TimeoutError):
        stream.run_batches(s, slow, ckpt, timeout_s=1)
    # the checkpoint lets the next call finish the rest
    stream.run_batches(stream.read_csv_stream(spark, src, "id long", max_files_per_trigger=1), lambda b, e: stream.write_epoch(b, e, out), ckpt)
    assert spark.read.parquet(out).select("id").distinct().count() == 40


def test_train_per_batch_counts_what_it_trains_on_and_refuses_gaps(spark):
    df = spark.range(200).select((F.col("id") % 2).cast("double").alias("label"), F.col("id").cast("double").alias("x"))
    src = files.write_features(df.coalesce(1), scratch_path(spark, "t-ok"), header=False)
    out = scratch_path(spark, "t-ok-out")
    stream.run_batches(stream.read_csv_stream(spark, src, "label double, x double"), stream.train_per_batch(["x"], out), scratch_path(spark, "t-ok-ckpt"))
    r = spark.read.parquet(out).head()
    assert r["n_train"] + r["n_test"] == 200 and r["n"] == r["n_test"]
    gaps = df.withColumn("x", F.when(F.col("x") % 4 != 0, F.col("x")))
    src = files.write_features(gaps.coalesce(1), scratch_path(spark, "t-gap"), header=False)
    with pytest.raises(Exception):  # noqa: B017, PT011 - the assembler's error inside the stream's
        stream.run_batches(stream.read_csv_stream(spark, src, "label double, x double"), stream.train_per_batch(["x"], scratch_path(spark, "t-gap-out")), scratch_path(spark, "t-gap-ckpt"))


def test_replay_gives_each_epochs_metrics_and_names_wrong_coefficients(spark):
    import random

    rng = random.Random(5)
    made = [(float(k), rng.gauss(k, 1.2), rng.gauss(-k, 2.0), i) for i in range(300) for k in (rng.randrange(3),)]
    df = spark.createDataFrame(made, "label double, x double, z double, id long")
    src = files.write_features(df.repartition(3, "id"), scratch_path(spark, "t-replay"), header=False)
    out, kept = scratch_path(spark, "t-replay-out"), scratch_path(spark, "t-replay-rows")
    s = stream.read_csv_stream(spark, src, "label double, x double, z double, id long", max_files_per_trigger=1)
    stream.run_batches(s, stream.train_per_batch(["x", "z"], out, key_cols=["id"], reg_param=0.01, rows_path=kept), scratch_path(spark, "t-replay-ckpt"))
    results, rows = spark.read.parquet(out), spark.read.parquet(kept)
    names = ["accuracy", "weighted_precision", "weighted_recall", "weighted_f1", "n", "n_train", "n_test"]
    want = {r["epoch_id"]: [r[c] for c in names] for r in results.collect()}
    got = {r["epoch_id"]: [r[c] for c in names] for r in stream.replay_metrics(rows, results, ["x", "z"], ["id"]).collect()}
    assert got.keys() == want.keys() and len(got) == 3
    assert all(abs(a - b) < 1e-9 for e in got for a, b in zip(got[e], want[e], strict=True))
    wrong = results.withColumn("coefficients", F.reverse("coefficients"))
    other = {r["epoch_id"]: r["accuracy"] for r in stream.replay_metrics(rows, wrong, ["x", "z"], ["id"]).collect()}
    assert all(abs(other[e] - want[e][0]) > 0.05 for e in want)


def test_model_checks_fail_on_a_damaged_model(spark):
    from pyspark.ml.classification import LogisticRegression

    df = separable(spark).withColumn("label", F.when(F.col("b") == 2, 1 - F.col("label")).otherwise(F.col("label")))
    fit = lambda reg: LogisticRegression(maxIter=500, regParam=reg, elasticNetParam=0.0, standardization=False, tol=1e-12).fit(df)
    good, other = fit(0.01), fit(1.0)
    assert models.logistic_gradient(good, df, 0.01) < 1e-5
    assert models.logistic_gradient(other, df, 0.01) > 1e-3
    facts = models.scored_rows(models.score(good, df)).collect()
    assert all(r["n"] == r["n_consistent"] and r["at_least_majority"] for r in facts) and sum(r["n"] for r in facts) == df.count()
    wrong = models.score(good, df).withColumn("prediction", 1 - F.col("prediction"))
    assert not all(r["n"] == r["n_consistent"] and r["at_least_majority"] for r in models.scored_rows(wrong).collect())


def test_files_of_a_stream_follow_the_rows(spark, monkeypatch):
    """A batch has more files as the table grows; the number of batches and the rows stay."""
    monkeypatch.setattr(catalog, "ROWS_PER_FILE", 100)
    for rows, wanted in ((90, 1), (300, 1), (2000, 7)):
        dealt, each = catalog._dealt(spark.range(rows), 3, "id")
        assert each == wanted and dealt.count() == rows
        sizes = dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(sizes) == 3 * each and max(r["count"] for r in sizes) < 200


def test_compressed_layout_reads_back(spark):
    """Files of the declared layouts are compressed; every text comes back."""
    df = spark.createDataFrame([(1, 'a, "b"\n'), (2, None), (3, "")], "k int, note string")
    path = files.write_features(df, scratch_path(spark, "t-gzip"), header=True, compression="gzip")
    assert all(f.endswith(".csv.gz") for f in spark.read.text(path).inputFiles())
    assert sorted(map(tuple, files.read_csv(spark, path, df.schema, encoded=True).collect())) == [(1, 'a, "b"\n'), (2, None), (3, "")]
