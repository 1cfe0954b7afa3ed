"""Missing-data profiling, counts, summary statistics, histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.functions.columns import is_missing
from tidecast.operators._chunks import as_list, join_on_keys, one_row


def drop_missing(df: DataFrame, subset=None) -> DataFrame:
    """Drop rows with NULL or NaN in any (or any of ``subset``) column (F1)."""
    return df.dropna(subset=subset)


def between_dates(df: DataFrame, start=None, end=None, col: str = "date") -> DataFrame:
    """``start <= col < end``; either bound may be None (F2). Plain filters, so they reach the scan."""
    if start is not None:
        df = df.where(F.col(col) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(col) < F.lit(end).cast("date"))
    return df


def null_count(df: DataFrame, cols=None) -> DataFrame:
    """Per column, rows where it IS NULL (F3). NaN is not NULL here, as in SQL."""
    cols = as_list(cols) or df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def null_profile(df: DataFrame, cols=None) -> DataFrame:
    """Per column, rows that are NULL or NaN, all in one pass."""
    cols = as_list(cols) or df.columns
    return df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in cols])


def to_long(wide_one_row: DataFrame, name: str = "column", value: str = "n") -> DataFrame:
    """One-row profile to (column, n) rows."""
    return wide_one_row.unpivot([], wide_one_row.columns, name, value)


def count_rows(df: DataFrame, by=()) -> DataFrame:
    """Row count, per key if given (A1)."""
    by = as_list(by)
    agg = F.count(F.lit(1)).alias("n")
    return df.groupBy(*by).agg(agg) if by else df.agg(agg)


def summary(df: DataFrame, col: str = "close", by=()) -> DataFrame:
    """min, max, mean, sample standard deviation of ``col`` (A2)."""
    by = as_list(by)
    aggs = [F.min(col).alias(f"min_{col}"), F.max(col).alias(f"max_{col}"),
            F.avg(col).alias(f"mean_{col}"), F.stddev_samp(col).alias(f"stddev_{col}")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def histogram(df: DataFrame, col: str = "close", bins: int = 20, by=(), clamp_last: bool = False,
              edges: bool = False) -> DataFrame:
    """Equal-width histogram: ``bin = int((x - min) / width)``, ``width = (max - min) / bins`` (A3, A4).

    The maximum falls alone into bin ``bins`` unless ``clamp_last``. A constant
    column has width 0: every row goes to bin 0 (``try_divide``, no error).
    Statistics and counts are one plan: the statistics are a scalar subquery
    (no key) or a per-key aggregate joined back (with keys); the counts are a
    partial + final aggregation, so a hot bin is pre-counted per task.
    """
    by = as_list(by)
    x = F.col(col)
    df = df.where(x.isNotNull() & ~F.isnan(x))
    if by:
        stats = df.groupBy(*by).agg(F.min(col).alias("_min"), F.max(col).alias("_max"))
        base = join_on_keys(df.select(*by, col), stats, by)
        mn, mx = F.col("_min"), F.col("_max")
    else:
        base = df.select(col)
        stats = one_row(df.agg(F.min(col).alias("mn"), F.max(col).alias("mx")))
        mn, mx = stats["mn"], stats["mx"]
    width = (mx - mn) / F.lit(float(bins))
    b = F.coalesce(F.try_divide(x - mn, width).cast("int"), F.lit(0))
    if clamp_last:
        b = F.least(b, F.lit(bins - 1))
    keys = [*by, b.alias("bin")]
    if edges:
        # the edge needs min and width next to the bin
        base = base.withColumns({"_w": width, "_mn": mn})
        out = base.groupBy(*by, b.alias("bin"), "_w", "_mn").agg(F.count(F.lit(1)).alias("frequency"))
        return out.select(*by, "bin", "frequency", (F.col("bin") * F.col("_w") + F.col("_mn")).alias("edge"))
    return base.groupBy(*keys).agg(F.count(F.lit(1)).alias("frequency"))


def count_by_split(df: DataFrame, flag: str = "is_train", by=()) -> DataFrame:
    """Rows in train and test."""
    return df.groupBy(*as_list(by), flag).agg(F.count(F.lit(1)).alias("n"))


def min_max(df: DataFrame, cols, by=()) -> DataFrame:
    """min and max of each column, a sanity check after scaling."""
    by = as_list(by)
    aggs = []
    for c in as_list(cols):
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
