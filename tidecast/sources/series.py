"""Economic series: long reader (S2), pivot to wide (S3), named bundles."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SERIES_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("series", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

# The two indicator lists the pipeline is run with (series ids
# of the public economic-data service), in their original order.
BUNDLES: dict[str, list[str]] = {
    "market": ["SP500", "DJIA", "NASDAQCOM", "VIXCLS", "GVZCLS", "DTWEXBGS", "IUDSOIA", "BAMLHE00EHYIEY",
               "DFF", "T10Y2Y", "DGS10", "T10YIE", "T5YIE", "DTB3"],
    "macro": ["UNRATE", "GDP", "FEDFUNDS", "CPIAUCNS", "M2", "DGS10", "PCE", "T10Y2Y", "USROA", "USROE",
              "WTISPLC", "HOUST", "INDPRO", "PAYEMS", "BAMLH0A0HYM2", "GS10", "BASE", "RIFSPPFAAD01NB",
              "EXUSEU", "NETEXP"],
}


def read_series(spark: SparkSession, path: str, ids: Iterable[str] | None = None, start=None, end=None,
                schema: T.StructType = SERIES_SCHEMA, fmt: str = "parquet") -> DataFrame:
    """Long series ``(date, series, value)`` for ``ids`` with ``start <= date < end``."""
    df = spark.read.schema(schema).format(fmt).load(path)
    return filter_series(df, ids, start, end)


def filter_series(df: DataFrame, ids: Iterable[str] | None = None, start=None, end=None) -> DataFrame:
    if ids is not None:
        df = df.where(F.col("series").isin(list(ids)))
    if start is not None:
        df = df.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("date") < F.lit(end).cast("date"))
    return df


def pivot_series(long: DataFrame, ids: Sequence[str], date_col: str = "date", key: str = "series",
                 value: str = "value") -> DataFrame:
    """One row per date, one column per id (S3).

    The id list is explicit, so Spark does not run a distinct job to find
    the pivot values; the pivot is a single two-phase aggregation.
    Duplicate (date, id) rows keep the largest value, which is deterministic.
    """
    return long.groupBy(date_col).pivot(key, list(ids)).agg(F.max(value))


def select_bundle(df: DataFrame, bundle: str | Sequence[str], keep: Sequence[str] = ("date",)) -> DataFrame:
    """Keep ``keep`` plus the bundle's series columns that exist (S6), matched case-insensitively."""
    ids = BUNDLES[bundle] if isinstance(bundle, str) else list(bundle)
    have = {c.lower(): c for c in df.columns}
    cols = [have[k.lower()] for k in keep if k.lower() in have]
    cols += [have[i.lower()] for i in ids if i.lower() in have]
    return df.select(*cols)
