"""Cleaning and imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.columns import bool_text_to_int, to_double
from kestrel.operators.profile import _q, modes, numeric_columns


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    """A fixed column list (names may hold ``(``, ``%``, ``[``)."""
    return df.select(*[F.col(_q(c)) for c in columns])


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop by name, case-insensitively; names that are absent are ignored."""
    wanted = {c.lower() for c in columns}
    return df.select(*[F.col(_q(c)) for c in df.columns if c.lower() not in wanted])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns in one projection."""
    return df.withColumnsRenamed(mapping)


def cast_to_double(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text columns to double (bad text -> NULL)."""
    return df.withColumns({c: to_double(_q(c)) for c in columns})


def cast_bool_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """``True``/``False`` text columns to 0/1 ints."""
    return df.withColumns({c: bool_text_to_int(_q(c)) for c in columns})


def lower_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Lower-case the listed text columns in one projection."""
    return df.withColumns({c: F.lower(F.col(_q(c))) for c in columns})


def drop_missing_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows with any NULL (or NaN in floating columns)."""
    return df.dropna(how="any", subset=columns)


def fit_means(df: DataFrame, columns: list[str] | None = None) -> dict[str, float]:
    """C1 fit: one aggregate pass; NaN and NULL are both left out of the mean."""
    cols = list(columns) if columns else numeric_columns(df)
    types = {f.name: f.dataType for f in df.schema.fields}

    def clean(c):
        x = F.col(_q(c)).cast("double")
        if isinstance(types[c], (T.DoubleType, T.FloatType)):
            x = F.when(~F.isnan(x), x)
        return x

    row = df.agg(*[F.avg(clean(c)).alias(f"a{i}") for i, c in enumerate(cols)]).head()
    return {c: row[f"a{i}"] for i, c in enumerate(cols)}


def impute_mean(df: DataFrame, columns: list[str] | None = None, overrides: dict[str, float] | None = None) -> DataFrame:
    """Fill NULL with the column mean (fitted, or the given literals).

    ``coalesce`` is used instead of ``fillna`` because ``fillna`` also replaces
    NaN, which the operator keeps. A filled integer column becomes double: a mean
    of 1.5 stays 1.5.
    """
    means = dict(fit_means(df, columns))
    means.update(overrides or {})
    types = {f.name: f.dataType for f in df.schema.fields}
    fills = {}
    for c, m in means.items():
        if m is None:
            continue
        kind = types[c] if isinstance(types[c], (T.FloatType, T.DoubleType, T.DecimalType)) else T.DoubleType()
        fills[c] = F.coalesce(F.col(_q(c)).cast(kind), F.lit(m).cast(kind))
    return df.withColumns(fills)


def impute_mode(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill NULL in text columns with the column's mode (A5); one pass to fit."""
    found = {r["column_name"]: r["mode"] for r in modes(df, columns).collect()}
    return df.withColumns({c: F.coalesce(F.col(_q(c)), F.lit(found[c])) for c in columns if found.get(c) is not None})
