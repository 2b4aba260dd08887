"""Batch scans and sinks (S1, S10) plus the parquet table loader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Parquet table ``<base>/<name>.parquet``; filters and projections push into the scan."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


# Text in files that this package writes: a line break, a backslash, NULL and the
# empty text each get a two-character code, so that a record is one line and
# files stay splittable. ``\\s`` is decoded last: no other code can arise from it.
_CODES = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"))
_NULL, _EMPTY = "\\0", "\\e"


def encode_text(df: DataFrame) -> DataFrame:
    """Each text column in its one-line form (reversed by ``decode_text``)."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            c = quoted(f.name)
            for raw, code in _CODES:
                c = F.replace(c, F.lit(raw), F.lit(code))
            c = F.when(c == "", F.lit(_EMPTY)).otherwise(F.coalesce(c, F.lit(_NULL)))
            out[f.name] = c
    return df.withColumns(out) if out else df


def decode_text(df: DataFrame) -> DataFrame:
    """Text columns of files written with ``encode_text``; works on a stream too."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            raw = c = quoted(f.name)
            for plain, code in reversed(_CODES):
                c = F.replace(c, F.lit(code), F.lit(plain))
            out[f.name] = F.when(raw == _NULL, F.lit(None)).when(raw == _EMPTY, F.lit("")).otherwise(c)
    return df.withColumns(out) if out else df


def quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def csv_options(header: bool, sep: str, timestamp_format: str = CSV_TIMESTAMP_FORMAT) -> dict:
    """Options that reader and writer share: quotes are doubled, blanks are text."""
    return {
        "header": header,
        "sep": sep,
        "quote": '"',
        "escape": '"',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        "timestampFormat": timestamp_format,
        "timestampNTZFormat": timestamp_format,
    }


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: bool = True,
    sep: str = ",",
    timestamp_format: str = CSV_TIMESTAMP_FORMAT,
    encoded: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with an explicit schema bound by position; no inference pass.

    ``encoded``: the file was written by ``write_features``; every text comes back
    exactly, NULL apart from empty. A file from elsewhere with line breaks inside
    quotes needs ``multi_line``, which makes each file one task.
    """
    options = csv_options(header, sep, timestamp_format) | {"mode": "PERMISSIVE", "multiLine": multi_line}
    df = spark.read.schema(schema).options(**options).csv(path)
    return decode_text(df) if encoded else df


def write_features(
    df: DataFrame,
    path: str,
    header: bool = False,
    sep: str = ",",
    files: int | None = None,
    timestamp_format: str = CSV_TIMESTAMP_FORMAT,
    compression: str = "none",
) -> str:
    """Write a feature table as CSV part files (the stream's input layout).

    Text is written in its one-line form (``encode_text``). ``files`` only reduces
    the file count with a narrow ``coalesce``; the write itself stays parallel per partition.
    ``compression`` (``gzip``) makes each file one task's work when it is read.
    """
    out = df.coalesce(files) if files else df
    encode_text(out).write.mode("overwrite").options(**csv_options(header, sep, timestamp_format)).csv(path, compression=compression)
    return path
