"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

import kestrel
from kestrel.session import scratch_path

# word separators of the text contracts: blank and \t \n \v \f \r
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but computes the plan a single time;
    a lost executor rereads the files instead of replaying the plan.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame) -> DataFrame:
    """``df`` itself if its rows come straight from files, else a written copy: a frame that ``with_row_key`` can read twice."""
    try:
        df.select(df.metadataColumn("_metadata")["row_index"])
    except AnalysisException:
        return materialise(df, "stored")
    return df


def with_row_key(df: DataFrame, key: str, **columns: Column) -> DataFrame:
    """``columns`` of ``df`` and a unique long per row that every later read gives again.

    The key is the number of the row's file, in the order of their names, and its place in that file. It does not depend on
    how files are cut into tasks, which follows the number of cores that are registered when a job starts. ``df`` must
    be ``stored``. The table of file names is as long as the list that Spark's driver keeps of them anyway.
    """
    place = df.metadataColumn("_metadata")
    files = df.select(place["file_path"].alias("_file")).distinct()
    files = files.select("_file", (F.row_number().over(Window.orderBy("_file")) - 1).cast("long").alias("_number"))
    rows = df.select(place["file_path"].alias("_file"), place["row_index"].alias("_index"), *[c.alias(name) for name, c in columns.items()])
    numbered = rows.join(F.broadcast(files), "_file")
    return numbered.select((F.shiftleft("_number", 40) + F.col("_index")).alias(key), *columns)


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, whatever their names."""
    return F.struct(*[df[c] for c in df.columns])


def hex60(col: Column) -> Column:
    """First 60 bits of the MD5 of a text as a long: a seeded order that SQL engines agree on."""
    return F.conv(F.substring(F.md5(col), 1, 15), 16, 10).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once.

    A lambda that names an outer expression evaluates it again for each
    element; binding it as the element of a one-element array avoids that.
    """
    return F.transform(F.array(value), body)[0]


def salted_join(
    big: DataFrame, small: DataFrame, keys: Sequence[str], salt_of: Sequence[str], how: str = "left", salts: int = 32
) -> DataFrame:
    """Equi-join (nulls match nulls) in which a hot key of ``big`` is dealt to ``salts`` tasks.

    ``small`` has at most one row per key and is repeated ``salts`` times. The repeated side is never broadcast: the planner
    takes it for as small as it was before.
    """
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in salt_of]), F.lit(salts)).cast("int")
    left = big.withColumn("_salt", salt)
    right = small.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[c for c in small.columns if c not in keys],
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_r_salt"),
    ).hint("merge")
    cond = left["_salt"] == right["_r_salt"]
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[f"_r_{k}"])
    return left.join(right, cond, how).drop("_salt", "_r_salt", *[f"_r_{k}" for k in keys])


def prepare_python(spark: SparkSession, rows: int = 512) -> None:
    """Make Python tasks ready: bounded Arrow batches, and this package on the workers' path.

    The package is sent with ``addPyFile`` once per application (Spark's file
    server gives it to each executor), so that a worker needs no installation.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    sc = spark.sparkContext
    if getattr(sc, "_kestrel_sent", None) == sc.applicationId:
        return
    root = Path(kestrel.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="kestrel-")) / "kestrel.zip"  # read by the driver alone
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._kestrel_sent = sc.applicationId
