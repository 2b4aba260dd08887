"""Scalar column functions.

All of them return ``Column`` expressions built from Spark built-ins, so they
stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def is_missing(c, data_type: T.DataType | None = None) -> Column:
    """NaN or NULL for floating columns, NULL for every other type.

    ``isnan`` on text raises under ANSI mode, so the test is chosen by type.
    """
    col = _col(c)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.isnan(col) | col.isNull()
    return col.isNull()


def to_double(c) -> Column:
    """Text to double; unparsable text becomes NULL instead of failing the job."""
    return _col(c).try_cast(T.DoubleType())


def bool_text_to_int(c) -> Column:
    """``'True'`` -> 1, ``'False'`` -> 0, anything else cast to int (NULL if it is not a number)."""
    col = _col(c)
    return (
        F.when(col == F.lit("True"), F.lit(1))
        .when(col == F.lit("False"), F.lit(0))
        .otherwise(col.try_cast(T.IntegerType()))
    )


def tokens(c, sep: str = " ") -> Column:
    """Split on a single separator; two separators in a row give an empty token."""
    import re

    return F.split(_col(c), re.escape(sep), -1)


def epoch_seconds(c, fmt: str = TIME_FORMAT, data_type: T.DataType | None = None) -> Column:
    """Time to epoch seconds (session time zone), NULL for text in another format.

    Text is parsed with ``try_to_timestamp``; timestamp columns are converted directly.
    """
    col = _col(c)
    if isinstance(data_type, T.TimestampNTZType):
        return F.unix_timestamp(col.cast(T.TimestampType()))
    if isinstance(data_type, T.TimestampType):
        return F.unix_timestamp(col)
    return F.unix_timestamp(F.try_to_timestamp(col, F.lit(fmt)))


def duration_seconds(start, end) -> Column:
    """End minus start, both already epoch seconds."""
    return _col(end) - _col(start)


def parse_vector(c) -> Column:
    """JSON array text to ``array<double>``; NULL or malformed text gives NULL."""
    return F.from_json(_col(c), T.ArrayType(T.DoubleType()))


def element(c, i: int) -> Column:
    """0-based array element, NULL when out of range (``[]`` would raise under ANSI)."""
    return F.get(_col(c), F.lit(i))


def whole_division(a, b) -> Column:
    """Truncated whole-number division of non-negative counts."""
    return F.floor(_col(a) / _col(b)).cast(T.LongType())
