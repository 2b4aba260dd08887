"""Structured Streaming sources, micro-batch sinks and per-batch training.

Streams run with a checkpoint location under the shared checkpoint folder, so
a restarted query resumes from its last committed batch. Per-batch results
are written as one partition per ``epoch_id`` with dynamic partition
overwrite, so replaying an epoch after a failure replaces, never duplicates.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.operators.balance import hash_split, split_side
from kestrel.operators.evaluate import weighted_metrics
from kestrel.sources.files import csv_options, decode_text


def read_csv_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: bool = False,
    sep: str = ",",
    max_files_per_trigger: int | None = None,
    encoded: bool = True,
) -> DataFrame:
    """S3: a directory of CSV files as an unbounded DataFrame (schema bound by position).

    ``encoded``: the files were written by ``sources.files.write_features``, whose text
    columns are decoded; pass False for files from elsewhere.
    """
    r = spark.readStream.schema(schema).options(**csv_options(header, sep))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.csv(path)
    return decode_text(df) if encoded else df


def prepare(stream: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Renames applied on the stream itself, before the sink."""
    return stream.withColumnsRenamed(renames)


def write_epoch(df: DataFrame, epoch_id: int, path: str) -> None:
    """Idempotent per-epoch write: overwrite only partition ``epoch_id=<id>``."""
    (
        df.withColumn("epoch_id", F.lit(int(epoch_id)).cast(T.LongType()))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("epoch_id")
        .parquet(path)
    )


def run_batches(stream: DataFrame, fn, checkpoint: str, timeout_s: float | None = None):
    """``foreachBatch(fn)`` with a checkpoint; process what is there and stop.

    ``availableNow`` drains the source in (possibly several) bounded batches and
    ends by itself, however long that takes. With ``timeout_s`` a stream that is
    still running then is stopped and ``TimeoutError`` is raised: a result is
    complete or there is none. The checkpoint lets a second call go on from there.
    """
    q = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    done = q.awaitTermination(timeout_s) if timeout_s is not None else (q.awaitTermination() or True)
    if not done:
        q.stop()
        raise TimeoutError(f"the stream was not drained within {timeout_s} s")
    return q


def train_per_batch(
    features: list[str],
    out_path: str,
    label: str = "label",
    key_cols: list[str] | None = None,
    max_iter: int = 100,
    reg_param: float = 0.3,
    elastic_net: float = 0.8,
    train_fraction: float = 0.7,
    rows_path: str | None = None,
):
    """R2: callback that splits, fits assembler + logistic regression, scores and
    writes ``(accuracy, weighted_precision, weighted_recall, weighted_f1, n,
    n_train, n_test, coefficients, intercepts)`` for the epoch. Nothing is carried between batches.
    With ``rows_path`` the epoch's rows are kept there too, so that ``replay_metrics`` can recompute any epoch.

    Rows without a label are left out. A NULL feature fails the batch, as
    training on part of the rows would go unnoticed: impute first. A batch with an empty side or a
    training side of a single class is recorded with NULL metrics instead of failing the stream.
    """

    def fn(batch: DataFrame, epoch_id: int) -> None:
        keys = key_cols or features
        batch = batch.where(F.col(label).isNotNull()).persist()
        try:
            train, test = hash_split(batch, keys, train_fraction)
            stats = train.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(label).alias("classes")).head()
            n_train, n_test = stats["n"], test.count()
            spark = batch.sparkSession
            if n_train == 0 or n_test == 0 or stats["classes"] < 2:
                res = spark.createDataFrame(
                    [(None, None, None, None, n_test, n_train, n_test, None, None)],
                    "accuracy double, weighted_precision double, weighted_recall double, weighted_f1 double, "
                    "n long, n_train long, n_test long, coefficients array<array<double>>, intercepts array<double>",
                )
            else:
                model = Pipeline(stages=[
                    VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error"),
                    LogisticRegression(maxIter=max_iter, regParam=reg_param, elasticNetParam=elastic_net, labelCol=label),
                ]).fit(train)
                scored = model.transform(test)
                res = weighted_metrics(scored, label, "prediction").withColumns(
                    {
                        "n_train": F.lit(n_train).cast("long"),
                        "n_test": F.lit(n_test).cast("long"),
                        "coefficients": F.array(*[F.array(*map(F.lit, row)) for row in model.stages[-1].coefficientMatrix.toArray().tolist()]),
                        "intercepts": F.array(*map(F.lit, model.stages[-1].interceptVector.toArray().tolist())),
                    }
                )
            if rows_path is not None:
                write_epoch(batch.select(*dict.fromkeys([*features, *keys, label])), epoch_id, rows_path)
            write_epoch(res, epoch_id, out_path)
        finally:
            batch.unpersist()

    return fn


def replay_metrics(rows: DataFrame, results: DataFrame, features: list[str], key_cols: list[str] | None = None,
                   label: str = "label", train_fraction: float = 0.7) -> DataFrame:
    """R2, checked: every epoch's metrics recomputed from its kept rows and the coefficients in ``results``.

    ``(epoch_id, accuracy, weighted_precision, weighted_recall, weighted_f1, n, n_train, n_test)`` by the split rule, a linear
    score per class and plain SQL aggregates; no model object and no evaluator takes part. Epochs that trained nothing have NULL metrics.
    """
    model = results.select("epoch_id", "coefficients", "intercepts")
    x = F.array(*[F.col(f"`{c}`").cast("double") for c in features])
    sided = rows.select("epoch_id", F.col(f"`{label}`").cast("double").alias("y"), x.alias("x"), split_side(key_cols or features, train_fraction).alias("trains"))
    dot = lambda w: F.aggregate(F.zip_with(w, "x", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    z = F.zip_with(F.transform("coefficients", dot), "intercepts", lambda a, b: a + b)
    # one row of scores is the second class against the first; of several the first highest wins
    best = F.when(F.size("z") == 1, (F.col("z")[0] > 0).cast("double")).otherwise((F.array_position("z", F.array_max("z")) - 1).cast("double"))
    scored = sided.join(model, "epoch_id").withColumn("z", z).withColumn("p", best).select("epoch_id", "y", "p", "trains")
    return rows.sparkSession.sql(
        """
        WITH sizes AS (SELECT epoch_id, count_if(trains) AS n_train, count_if(NOT trains) AS n_test FROM {scored} GROUP BY epoch_id),
        cells AS (SELECT epoch_id, y, p, count(*) AS c FROM {scored} WHERE NOT trains AND p IS NOT NULL GROUP BY epoch_id, y, p),
        truth AS (SELECT epoch_id, y AS k, sum(c) AS t, sum(CASE WHEN y = p THEN c ELSE 0 END) AS hit FROM cells GROUP BY epoch_id, y),
        said AS (SELECT epoch_id, p AS k, sum(c) AS s FROM cells GROUP BY epoch_id, p),
        classes AS (SELECT t.epoch_id, t.t, t.hit, t.hit / t.t AS r, coalesce(t.hit / s.s, 0D) AS q
                    FROM truth t LEFT JOIN said s ON s.epoch_id = t.epoch_id AND s.k = t.k),
        metrics AS (SELECT epoch_id, sum(hit) / sum(t) AS accuracy, sum(t * q) / sum(t) AS weighted_precision, sum(t * r) / sum(t) AS weighted_recall,
                           sum(CASE WHEN q + r > 0 THEN t * 2 * q * r / (q + r) ELSE 0D END) / sum(t) AS weighted_f1 FROM classes GROUP BY epoch_id)
        SELECT sizes.epoch_id, accuracy, weighted_precision, weighted_recall, weighted_f1, n_test AS n, n_train, n_test
        FROM sizes LEFT JOIN metrics ON metrics.epoch_id = sizes.epoch_id
        """,
        scored=scored,
    )


def score_stream(model, stream: DataFrame) -> DataFrame:
    """Apply a fitted (saved and re-loaded) model to a stream; stays a stream."""
    return model.transform(stream)
