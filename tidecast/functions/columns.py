"""Projection and missing-value helpers."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOAT_TYPES = (T.FloatType, T.DoubleType)
_NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def float_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _FLOAT_TYPES)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC_TYPES)]


def _dtype(df: DataFrame, c: str) -> T.DataType:
    return df.schema[c].dataType


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns in one projection (P1); names match case-insensitively."""
    lower = {k.lower(): v for k, v in mapping.items()}
    return df.select(*[F.col(c).alias(lower.get(c.lower(), c)) for c in df.columns])


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns that exist; unknown names are ignored, as ``DataFrame.drop`` does."""
    return df.drop(*cols)


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name (P5)."""
    return df.toDF(*[c.lower() for c in df.columns])


def feature_columns(df: DataFrame, label: str = "close", exclude: Iterable[str] = ()) -> list[str]:
    """Every column but the label and ``exclude`` (P6). Non-numeric columns are left out."""
    skip = {label.lower(), *(e.lower() for e in exclude)}
    return [c for c in numeric_columns(df) if c.lower() not in skip]


def split_xy(df: DataFrame, label: str = "close", keys: Iterable[str] = (), exclude: Iterable[str] = ()):
    """Features and label as two frames that share ``keys`` (P7). Chosen by name, never position."""
    keys = list(keys)
    feats = [c for c in feature_columns(df, label, exclude=[*keys, *exclude])]
    return df.select(*keys, *feats), df.select(*keys, label)


def is_missing(df: DataFrame, c: str) -> Column:
    """NULL, or NaN for float/double columns (X7). ``isnan`` is only applied where it is defined."""
    col = F.col(c)
    if isinstance(_dtype(df, c), _FLOAT_TYPES):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def sentinel_to_null_expr(df: DataFrame, c: str, value=float("nan")) -> Column:
    """Column ``c`` with the sentinel turned into NULL.

    NaN sentinel: only float/double columns can hold it, others pass through
    (comparing an integer column with the string 'NaN' raises under ANSI).
    Numeric sentinel: ``when(c != value, c)``. ``value=None``: no sentinel.
    """
    col = F.col(c)
    dt = _dtype(df, c)
    if value is None:
        return col
    if isinstance(value, float) and math.isnan(value):
        if isinstance(dt, _FLOAT_TYPES):
            return F.when(~F.isnan(col), col)
        return col
    return F.when(col != F.lit(value), col)
