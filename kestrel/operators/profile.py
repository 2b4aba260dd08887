"""Profiling operators.

Each profile is one aggregation pass over the input (partial aggregation on
the map side, a single-row or small final result) and is returned as a long
DataFrame; nothing is transposed on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from kestrel.functions.columns import is_missing
from kestrel.operators.joins import degree_join, salts_of
from kestrel.session import cut_lineage, scratch_path

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns whose type is numeric, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def string_columns(df: DataFrame) -> list[str]:
    """Columns of text, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def shape(df: DataFrame) -> DataFrame:
    """A1: one row ``(n_rows, n_cols)``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns)).cast(T.LongType())
    )


def schema_table(df: DataFrame) -> DataFrame:
    """The schema as rows ``(position, column_name, data_type, nullable)``.

    Built from the schema metadata only (no data is read).
    """
    rows = [
        (i + 1, f.name, f.dataType.simpleString(), f.nullable)
        for i, f in enumerate(df.schema.fields)
    ]
    schema = "position int, column_name string, data_type string, nullable boolean"
    return df.sparkSession.createDataFrame(rows, schema)


def _unpivot_row(row_df: DataFrame, names: list[str], value_cols: dict[str, callable], key: str = "column_name") -> DataFrame:
    """Turn a one-row frame of per-column statistics into one row per column."""
    structs = [
        F.struct(F.lit(n).alias(key), *[fn(n).alias(out) for out, fn in value_cols.items()])
        for n in names
    ]
    return row_df.select(F.inline(F.array(*structs)))


def missing_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing values per column, sorted by count descending.

    One pass: a ``count_if`` per column in a single aggregate, then an unpivot
    of that single row.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = list(columns) if columns else list(df.columns)
    aliases = {c: f"m{i}" for i, c in enumerate(cols)}
    one = df.agg(*[F.count_if(is_missing(F.col(_q(c)), types[c])).alias(aliases[c]) for c in cols])
    long = _unpivot_row(one, cols, {"n_missing": lambda n: F.col(aliases[n])})
    return long.orderBy(F.desc("n_missing"), F.asc("column_name"))


def _stacked(df: DataFrame, columns: list[str], kind: T.DataType) -> DataFrame:
    """``(column_name, value)`` for every listed column, in one scan."""
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(_q(c)).cast(kind).alias("value")) for c in columns]
    return df.select(F.explode(F.array(*pairs)).alias("kv")).select("kv.column_name", "kv.value")


def exact_percentiles(df: DataFrame, columns: list[str], percentiles=(0.25, 0.5, 0.75)) -> DataFrame:
    """``(column_name, p, value)``: the value at rank ceil(p * n) of each column's n values, exact at any size.

    Distinct values with their counts are sorted over all tasks by a range
    partitioning on (column, value) and written once with their partition's
    number. The partitions' totals say which of them holds each rank, and only those are
    searched. No task sees more than one range, and no sketch is gathered anywhere.
    """
    spark = df.sparkSession
    counts = _stacked(df, columns, T.DoubleType()).where("value IS NOT NULL")
    counts = counts.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, "ranked-values")
    counts.repartitionByRange("column_name", "value").withColumn("part", F.spark_partition_id()).write.parquet(path)
    counts = spark.read.parquet(path)
    before = Window.partitionBy("column_name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.groupBy("column_name", "part").agg(F.sum("n").alias("part_n"))
    parts = parts.withColumn("start", F.coalesce(F.sum("part_n").over(before), F.lit(0)))
    total = Window.partitionBy("column_name")
    wanted = parts.withColumn("total", F.sum("part_n").over(total)).withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in percentiles])))
    wanted = wanted.withColumn("rank", F.greatest(F.lit(1), F.ceil(F.col("p") * F.col("total"))))
    wanted = wanted.where((F.col("rank") > F.col("start")) & (F.col("rank") <= F.col("start") + F.col("part_n")))
    # one row per column and percentile
    wanted = F.broadcast(wanted.select("column_name", "part", "start", "p", "rank"))
    upto = Window.partitionBy("column_name", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranges = counts.join(F.broadcast(wanted.select("column_name", "part").distinct()), ["column_name", "part"], "left_semi")
    ranked = ranges.withColumn("upto", F.sum("n").over(upto)).join(wanted, ["column_name", "part"])
    last = F.col("start") + F.col("upto")
    return ranked.where((last >= F.col("rank")) & (last - F.col("n") < F.col("rank"))).select("column_name", "p", "value")


def summary(df: DataFrame, columns: list[str] | None = None, percentiles=(0.25, 0.5, 0.75)) -> DataFrame:
    """A3: count, mean, sample stddev, min, percentiles, max for each numeric column.

    One aggregate pass for the moments, and ``exact_percentiles`` for the ranks.
    """
    cols = list(columns) if columns else numeric_columns(df)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(_q(c)).cast(T.DoubleType())
        aggs += [
            F.count(x).alias(f"n{i}"),
            F.avg(x).alias(f"mean{i}"),
            F.stddev_samp(x).alias(f"sd{i}"),
            F.min(x).alias(f"min{i}"),
            F.max(x).alias(f"max{i}"),
        ]
    idx = {c: i for i, c in enumerate(cols)}
    fields = {
        "count": lambda n: F.col(f"n{idx[n]}"),
        "mean": lambda n: F.col(f"mean{idx[n]}"),
        "stddev": lambda n: F.col(f"sd{idx[n]}"),
        "min": lambda n: F.col(f"min{idx[n]}"),
        "max": lambda n: F.col(f"max{idx[n]}"),
    }
    moments = _unpivot_row(df.agg(*aggs), cols, fields)
    ranks = exact_percentiles(df, cols, percentiles).groupBy("column_name").agg(
        *[F.max(F.when(F.col("p") == float(p), F.col("value"))).alias(f"p{int(round(p * 100))}") for p in percentiles]
    )
    # one row per column on either side
    out = moments.join(ranks, "column_name", "left")
    return out.select("column_name", "count", "mean", "stddev", "min", *[f"p{int(round(p * 100))}" for p in percentiles], "max")


def summary_text(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A3 for text columns: ``(column_name, count, min, max)``; mean and deviation have no meaning there."""
    cols = list(columns) if columns else string_columns(df)
    stacked = _stacked(df, cols, T.StringType())
    return stacked.groupBy("column_name").agg(F.count("value").alias("count"), F.min("value").alias("min"), F.max("value").alias("max"))


def value_counts(df: DataFrame, columns: list[str], drop_nulls: bool = False) -> DataFrame:
    """A4: ``(column_name, value, n)`` for every listed column in one shuffle.

    The table is unpivoted to ``(column_name, value)`` and grouped once; the
    hash aggregate combines on the map side, so a hot value costs one row per
    partition, not one row per occurrence.
    """
    stacked = _stacked(df, columns, T.StringType())
    if drop_nulls:
        stacked = stacked.where(F.col("value").isNotNull())
    return stacked.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Most frequent non-null value per column; ties go to the smallest value.

    The largest count per column is a hash aggregate with one row per column;
    only values that reach it are compared as text. A
    column with millions of distinct values is never gathered into one task.
    """
    counts = value_counts(df, columns, drop_nulls=True)
    # one row per listed column
    top = F.broadcast(counts.groupBy("column_name").agg(F.max("n").alias("n")))
    return counts.join(top, ["column_name", "n"]).groupBy("column_name").agg(F.min("value").alias("mode"), F.max("n").alias("n"))


def correlation(df: DataFrame, columns: list[str] | None = None, method: str = "pearson") -> DataFrame:
    """Correlation matrix as long rows ``(col_a, col_b, corr)``.

    Pearson: one pass for means and counts, one flat aggregate of products of
    centred columns. A pair skips rows where either side is NULL; only pairs with
    such rows need their own ``corr``. Spearman: Pearson of average ranks, ranked anew for each pair among the rows that have both
    values (``_spearman``).
    """
    cols = list(columns) if columns else numeric_columns(df)
    if method == "spearman":
        return _spearman(df, cols)
    if method != "pearson":
        raise ValueError(method)
    x = [F.col(_q(c)).cast("double") for c in cols]
    first = df.agg(F.count(F.lit(1)).alias("n"), *[f(v).alias(f"{k}{i}") for i, v in enumerate(x) for k, f in (("n", F.count), ("m", F.avg))]).head()
    whole = [first[f"n{i}"] == first["n"] and first["n"] > 0 for i in range(len(cols))]
    centred = [v - F.lit(first[f"m{i}"]) if whole[i] else v for i, v in enumerate(x)]
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    aggs = [
        (F.sum(centred[i] * centred[j]) if whole[i] and whole[j] else F.corr(x[i], x[j])).alias(f"c{i}_{j}") for i, j in pairs
    ]
    one = df.agg(*aggs)
    structs = []
    for i, j in pairs:
        c = F.col(f"c{i}_{j}")
        if whole[i] and whole[j]:
            spread = F.sqrt(F.col(f"c{i}_{i}")) * F.sqrt(F.col(f"c{j}_{j}"))
            c = F.when(spread > 0, c / spread)
        for a, b in {(i, j), (j, i)}:
            structs.append(F.struct(F.lit(cols[a]).alias("col_a"), F.lit(cols[b]).alias("col_b"), c.alias("corr")))
    return one.select(F.inline(F.array(*structs)))


def _spearman(df: DataFrame, cols: list[str]) -> DataFrame:
    """Spearman's matrix ``(col_a, col_b, corr)``; a pair leaves out the rows in which either side is NULL or NaN, and no others.

    Per pair the rows are first counted by their two values. The distinct values of each side are sorted over all tasks by a
    range partitioning and written; a value's average rank follows from the counts before it (those of its range,
    and the totals of the ranges before). Ranks are joined back with salts for frequent values, and enter the sums
    centred on their mean, which is known exactly.
    """
    spark = df.sparkSession
    x = [F.col(_q(c)).cast("double") for c in cols]
    x = [F.when(~F.isnan(v), v) for v in x]
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    both = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), x[i].alias("a"), x[j].alias("b")) for i, j in pairs])
    rows = df.select(F.explode(both).alias("p")).select("p.*").where("a IS NOT NULL AND b IS NOT NULL")
    rows = cut_lineage(rows.groupBy("i", "j", "a", "b").agg(F.count(F.lit(1)).alias("n")))
    for side, rank in (("a", "rank_a"), ("b", "rank_b")):
        ranks = _average_ranks(rows, side).select(F.struct("i", "j", F.col(side).alias("v")).alias("_key"), F.col("rank").alias(rank))
        keyed = rows.withColumn("_key", F.struct("i", "j", F.col(side).alias("v")))
        rows = degree_join(keyed, ranks, "_key", ["a", "b"], salts_of(keyed, "_key")).drop("_key")
    totals = rows.groupBy("i", "j").agg(F.sum("n").alias("all_n"))
    # a row per pair of columns
    rows = rows.join(F.broadcast(totals), ["i", "j"])
    u, v = (F.col(r) - (F.col("all_n") + 1) / 2 for r in ("rank_a", "rank_b"))
    sums = rows.groupBy("i", "j").agg(F.sum(F.col("n") * u * v).alias("uv"), F.sum(F.col("n") * u * u).alias("uu"), F.sum(F.col("n") * v * v).alias("vv"))
    names = spark.createDataFrame([(i, j, cols[i], cols[j]) for i, j in pairs], "i int, j int, col_a string, col_b string")
    spread = F.sqrt("uu") * F.sqrt("vv")
    found = F.broadcast(names).join(sums, ["i", "j"], "left").withColumn("corr", F.when(spread > 0, F.col("uv") / spread))
    mirror = found.where("i <> j").select(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "corr")
    return found.select("col_a", "col_b", "corr").unionByName(mirror)


def _average_ranks(rows: DataFrame, side: str) -> DataFrame:
    """``(i, j, side, rank)``: average rank of each value among the ``n`` rows of its pair."""
    counts = rows.groupBy("i", "j", side).agg(F.sum("n").alias("n"))
    dealt = cut_lineage(counts.repartitionByRange("i", "j", side).withColumn("part", F.spark_partition_id()))
    pair = Window.partitionBy("i", "j")
    starts = dealt.groupBy("i", "j", "part").agg(F.sum("n").alias("part_n"))
    start = F.coalesce(F.sum("part_n").over(pair.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a row per pair and range
    starts = F.broadcast(starts.select("i", "j", "part", start.alias("start")))
    upto = F.sum("n").over(Window.partitionBy("i", "j", "part").orderBy(side).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = dealt.withColumn("upto", upto).join(starts, ["i", "j", "part"])
    return ranked.select("i", "j", side, (F.col("start") + F.col("upto") - (F.col("n") - 1) / 2).alias("rank"))


def top_n(df: DataFrame, n: int, order_by: list) -> DataFrame:
    """First ``n`` rows after an explicit sort (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order_by).limit(n)
