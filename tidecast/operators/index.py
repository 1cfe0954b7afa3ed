"""Dense row index in time order (O2, O3) and partition count (A5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.operators._chunks import CHUNK, KEY, ROWS, as_list, auto_chunk, join_on_keys, laid_out, summarized, unpacked

UNB = Window.unboundedPreceding


def row_index(df: DataFrame, order, by=(), name: str = "idx", count: str | None = None,
              chunk=None) -> DataFrame:
    """0-based dense index per ``by`` key in ``order`` (O2).

    ``row_number`` over the key, never ``monotonically_increasing_id`` (which
    leaves gaps between partitions). The order must be unique within a key
    (add tie-breaking columns to ``order`` otherwise): a retried task then
    numbers its rows exactly as the first attempt did. ``count`` adds the key's row count,
    computed in the same window so no extra shuffle is needed.

    ``chunk`` (O3) numbers rows within (key, bucket) and adds the rows of the
    earlier buckets, taken from a per-bucket count table with a running sum;
    the result equals the unchunked index while no task holds a whole key.
    """
    by = as_list(by)
    ords = [F.col(o) if isinstance(o, str) else o for o in as_list(order)]
    chunk = auto_chunk(df, by, order, chunk)
    if chunk is None:
        w = Window.partitionBy(*by).orderBy(*ords)
        out = df.withColumn(name, (F.row_number().over(w) - 1).cast("long"))
        if count:
            out = out.withColumn(count, F.count(F.lit(1)).over(Window.partitionBy(*by)))
        return out
    ex = laid_out(df, by, as_list(order)[0], chunk)
    w = Window.partitionBy(KEY).orderBy(*ords)
    numbered = ex.select(KEY, *unpacked(ex, df.columns)).withColumn("_rn", F.row_number().over(w) - 1)
    wk = Window.partitionBy(*by).orderBy(CHUNK)
    offs = [F.coalesce(F.sum(ROWS).over(wk.rowsBetween(UNB, -1)), F.lit(0)).alias("_off")]
    if count:
        offs.append(F.sum(ROWS).over(Window.partitionBy(*by)).alias(count))
    table = summarized(ex, by).select(KEY, *offs)
    out = numbered.join(table, KEY, "left").withColumn(name, (F.col("_off") + F.col("_rn")).cast("long"))
    keep = [*df.columns, name] + ([count] if count else [])
    return out.select(*keep)


def partition_count(df: DataFrame) -> DataFrame:
    """Number of partitions of ``df``, empty ones included (A5).

    A property of the plan, read without running a job over the rows."""
    return df.sparkSession.createDataFrame([(df.rdd.getNumPartitions(),)], "partitions long")


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows of each non-empty partition, as a distributed aggregate."""
    return df.select(F.spark_partition_id().alias("partition")).groupBy("partition").agg(F.count("*").alias("n"))


def partition_rows(df: DataFrame) -> DataFrame:
    """Partitions of ``df``, those of them that are empty, and all rows: one row, counted in the partitions."""
    found = partition_sizes(df).agg(F.count("*").alias("filled"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))
    whole = F.lit(df.rdd.getNumPartitions()).cast("long")
    return found.select(whole.alias("partitions"), (whole - F.col("filled")).alias("empty"), "n_rows")


def symbol_index(df: DataFrame, col: str = "symbol", name: str = "symbol_idx") -> DataFrame:
    """Add the 0-based rank of the string column's value among its distinct values, NULL first, so that one model
    over all keys can tell them apart. Ranked is the table of distinct values, in chunks by their first character."""
    ranks = row_index(df.select(col).distinct(), col, name=name, chunk=F.substring(F.col(col), 1, 1))
    return join_on_keys(df, ranks, col)
