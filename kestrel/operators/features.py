"""Feature engineering."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, VectorAssembler, Word2Vec
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from kestrel.functions.columns import duration_seconds, element, epoch_seconds, parse_vector, tokens
from kestrel.operators.joins import ROWS_PER_SALT, SALTED_KEYS, degree_join
from kestrel.operators.profile import _q, value_counts
from kestrel.session import cut_lineage


def add_tokens(df: DataFrame, column: str, out: str | None = None, sep: str = " ") -> DataFrame:
    """Whole text split on one separator into an array column."""
    return df.withColumn(out or column, tokens(_q(column), sep))


def add_epoch_seconds(df: DataFrame, columns: list[str], suffix: str = "Vec", fmt: str = "yyyy-MM-dd HH:mm:ss", drop: bool = True) -> DataFrame:
    """Each time column to epoch seconds as ``<name><suffix>``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = df.withColumns({c + suffix: epoch_seconds(_q(c), fmt, types[c]) for c in columns})
    return out.drop(*columns) if drop else out


def add_duration(df: DataFrame, start: str, end: str, out: str = "Duration", drop: bool = True) -> DataFrame:
    """``out = end - start`` (epoch seconds)."""
    res = df.withColumn(out, duration_seconds(_q(start), _q(end)))
    return res.drop(start, end) if drop else res


def add_parsed_vector(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """JSON array text to ``array<double>`` with the built-in JSON reader."""
    return df.withColumn(out or column, parse_vector(_q(column)))


def expand_array(df: DataFrame, column: str, width: int, drop: bool = True) -> DataFrame:
    """Array elements as columns named ``column[0]``, ``column[1]``, ..."""
    res = df.withColumns({f"{column}[{i}]": element(_q(column), i) for i in range(width)})
    return res.drop(column) if drop else res


BROADCAST_LABELS = 100_000
_ORDERS = {
    "frequencyDesc": lambda: [F.desc("n"), F.asc("value")],
    "frequencyAsc": lambda: [F.asc("n"), F.asc("value")],
    "alphabetDesc": lambda: [F.desc("value")],
    "alphabetAsc": lambda: [F.asc("value")],
}


@dataclass
class LabelIndex:
    """Fitted string index: ``labels`` has a row ``(column_name, value, n, label_index)`` per distinct value.

    The table stays distributed; only the number of labels of each column is known on the driver.
    """

    labels: DataFrame
    columns: list[str]
    suffix: str = "Vec"
    handle_invalid: str = "error"
    sizes: dict[str, int] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``<column><suffix>`` for each indexed column.

        Up to BROADCAST_LABELS labels of a column are sent to every task. Beyond that only the most frequent are (at most
        SALTED_KEYS, so what is left has no hot value), and the other rows are joined by a shuffle, rows
        that need no join being dealt by the partition they come from.
        """
        for i, c in enumerate(self.columns):
            value, index = f"_label_{i}", f"_index_{i}"
            table = self.labels.where(F.col("column_name") == c).select(F.col("value").alias(value), F.col("label_index").alias(index), "n")
            text = F.col(_q(c)).cast("string")
            if self.sizes.get(c, 0) <= BROADCAST_LABELS:
                df = df.join(F.broadcast(table.drop("n")), text == F.col(value), "left").drop(value)
            else:
                often = table.where(F.col("n") > ROWS_PER_SALT).orderBy(F.desc("n"), value).limit(SALTED_KEYS)
                often = often.select(F.col(value).alias("_often"), F.col(index).alias("_often_index"))
                df = df.join(F.broadcast(often), text == F.col("_often"), "left")
                df = df.withColumn("_rest", F.when(F.col("_often").isNull(), text))
                df = df.withColumn("_deal", F.when(F.col("_rest").isNull(), F.spark_partition_id() + 1).otherwise(0))
                df = df.join(table.drop("n").withColumn("_one", F.lit(0)), (F.col("_rest") == F.col(value)) & (F.col("_deal") == F.col("_one")), "left")
                df = df.withColumn(index, F.coalesce("_often_index", index)).drop("_often", "_often_index", "_rest", "_deal", "_one", value)
            if self.handle_invalid == "skip":
                df = df.where(F.col(index).isNotNull())
            unseen = {
                "keep": F.lit(float(self.sizes.get(c, 0))),
                "skip": F.lit(None).cast("double"),
                "error": F.raise_error(F.lit(f"column {c} has NULL or a value that the index does not know")).cast("double"),
            }[self.handle_invalid]
            df = df.withColumn(c + self.suffix, F.when(F.col(index).isNull(), unseen).otherwise(F.col(index))).drop(index)
        return df

    def inverse(self, df: DataFrame, column: str, out: str) -> DataFrame:
        """``df`` with the text of ``<column><suffix>`` as ``out``; an unknown index gives NULL."""
        table = self.labels.where(F.col("column_name") == column).select(F.col("label_index").alias("_index"), F.col("value").alias(out), "n")
        at = F.col(_q(column + self.suffix))
        if self.sizes.get(column, 0) <= BROADCAST_LABELS:
            return df.join(F.broadcast(table.drop("n")), at == F.col("_index"), "left").drop("_index")
        hot = table.where(F.col("n") > ROWS_PER_SALT).orderBy(F.desc("n"), "_index").limit(SALTED_KEYS)
        hot = hot.select("_index", F.ceil(F.col("n") / F.lit(ROWS_PER_SALT)).cast("int").alias("_salts"))
        return degree_join(df.withColumn("_index", at), table.drop("n"), "_index", df.columns, hot, "left").drop("_index")

    @property
    def labelsArray(self) -> list[list[str]]:  # noqa: N802 - the name that Spark ML users know
        """Labels of each column in index order, gathered on the driver: for short label lists."""
        rows = self.labels.orderBy("column_name", "label_index").collect()
        return [[r["value"] for r in rows if r["column_name"] == c] for c in self.columns]


def string_index(
    df: DataFrame,
    columns: list[str],
    suffix: str = "Vec",
    handle_invalid: str = "error",
    order: str = "frequencyDesc",
) -> tuple[DataFrame, LabelIndex]:
    """index text columns by descending frequency (ties alphabetical). Returns ``(frame, LabelIndex)``.

    All columns are counted in one aggregation. The distinct values are range-partitioned in index order and
    written; a value's index is its place in its range plus the sizes of the ranges before, so no task and no
    driver sees all labels. NULL fails by default, as in Spark ML: impute first, or pass ``'keep'`` (NULL and
    unseen values get the next index) or ``'skip'`` (their rows leave) on purpose.
    """
    if handle_invalid not in ("error", "keep", "skip"):
        raise ValueError(handle_invalid)
    keys = _ORDERS[order]()
    counts = value_counts(df, list(columns), drop_nulls=True)
    dealt = cut_lineage(counts.repartitionByRange("column_name", *keys).withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("column_name", "part").orderBy(*keys)
    before = Window.partitionBy("column_name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a row per column and range
    starts = dealt.groupBy("column_name", "part").agg(F.count(F.lit(1)).alias("c"))
    starts = F.broadcast(starts.select("column_name", "part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("start")))
    ranked = dealt.withColumn("place", F.row_number().over(inside) - 1).join(starts, ["column_name", "part"])
    labels = cut_lineage(ranked.select("column_name", "value", "n", (F.col("start") + F.col("place")).cast("double").alias("label_index")))
    sizes = {r["column_name"]: r["c"] for r in labels.groupBy("column_name").agg(F.count(F.lit(1)).alias("c")).collect()}
    model = LabelIndex(labels, list(columns), suffix, handle_invalid, sizes)
    return model.transform(df), model


def one_hot(df: DataFrame, columns: list[str], suffix: str = "Hot", drop_last: bool = True, handle_invalid: str = "error"):
    """one-hot vectors from index columns. Returns ``(frame, model)``.

    With ``handle_invalid='keep'`` Spark adds an extra slot for unseen
    indices and ``drop_last`` then drops that slot instead of the last category.
    """
    model = OneHotEncoder(
        inputCols=list(columns), outputCols=[c + suffix for c in columns], dropLast=drop_last, handleInvalid=handle_invalid
    ).fit(df)
    return model.transform(df), model


def assemble(
    df: DataFrame,
    features: list[str],
    label: str | None = None,
    out: str = "features",
    handle_invalid: str = "error",
    keep: list[str] | None = None,
) -> DataFrame:
    """Assemble feature columns into one vector, label renamed to ``label``.

    The label is refused as a feature (the reference lists it twice).
    """
    if label is not None and label in features:
        raise ValueError(f"label column {label!r} must not be an input feature")
    vec = VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid=handle_invalid).transform(df)
    cols = [F.col(out)] + [F.col(_q(k)) for k in (keep or [])]
    if label is not None:
        cols.append(F.col(_q(label)).cast(T.DoubleType()).alias("label"))
    return vec.select(*cols)


def text_embedding(
    df: DataFrame,
    column: str,
    out: str | None = None,
    vector_size: int = 100,
    min_count: int = 5,
    seed: int = 42,
    num_partitions: int = 8,
    max_iter: int = 1,
):
    """Word2Vec document vector = mean of its word vectors.

    The text column is tokenised on single blanks first (whole text, long
    sentences are cut into 1000-word chunks by Word2Vec itself, not dropped);
    NULL text becomes an empty token list. ``num_partitions`` spreads training
    over executors (MLlib's default trains in one task).
    Returns ``(frame, model)``.
    """
    out = out or column + "Vec"
    tok = df.withColumn("_tokens", F.coalesce(tokens(_q(column)), F.array().cast("array<string>")))
    model = Word2Vec(
        vectorSize=vector_size,
        minCount=min_count,
        seed=seed,
        numPartitions=num_partitions,
        maxIter=max_iter,
        inputCol="_tokens",
        outputCol=out,
    ).fit(tok)
    return model.transform(tok).drop("_tokens"), model
