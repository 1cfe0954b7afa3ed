"""Time-ordered splits, top-k rows and set difference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.operators._chunks import as_list, join_on_keys
from tidecast.operators.index import row_index


def _with_index(df: DataFrame, order, by, idx: str, chunk) -> DataFrame:
    """``df`` with a dense index ``idx`` and the key's row count ``_n``."""
    by = as_list(by)
    if idx not in df.columns:
        return row_index(df, order, by, name=idx, count="_n", chunk=chunk)
    if not by:
        # one global value: a scalar subquery, evaluated once (never a window over the whole table)
        return df.withColumn("_n", df.agg(F.max(idx) + 1).scalar())
    if chunk is None:
        # same partitioning as the window that made the index: no extra shuffle
        return df.withColumn("_n", F.max(idx).over(Window.partitionBy(*by)) + 1)
    counts = df.groupBy(*by).agg((F.max(idx) + 1).alias("_n"))
    return join_on_keys(df, counts, by)


def ordered_split(df: DataFrame, ratio: float = 0.8, order="date", by=(), idx: str = "idx",
                  flag: str = "is_train", chunk=None) -> DataFrame:
    """First ``int(n * ratio)`` rows of each key in time order are train.

    One pass: a flag column on the dense index. No ``limit`` + ``subtract``,
    whose result depends on evaluation order and hashes whole rows.
    """
    out = _with_index(df, order, by, idx, chunk)
    return out.withColumn(flag, F.col(idx) < F.floor(F.col("_n") * F.lit(float(ratio)))).drop("_n")


def tail_split(df: DataFrame, n: int, order="date", by=(), idx: str = "idx", flag: str = "is_train",
               chunk=None) -> DataFrame:
    """The last ``n`` rows of each key are test, the rest train."""
    out = _with_index(df, order, by, idx, chunk)
    return out.withColumn(flag, F.col(idx) < F.col("_n") - F.lit(int(n))).drop("_n")


def hash_split(df: DataFrame, key: Sequence[str] | str, weights=(0.8, 0.2), seed: int = 42,
               name: str = "split") -> DataFrame:
    """Repeatable random split: part number from a hash of the key and seed.

    ``randomSplit`` depends on the input order of each partition; a hash of
    the row key does not, so re-evaluation gives the same parts.
    """
    total = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        bounds.append(round(acc * (1 << 28)))
    # the first 28 bits of an MD5 over the key's text, which any SQL engine can compute; NULL counts as the empty text
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in as_list(key)], F.lit(str(int(seed))))
    u = F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long")
    part = F.lit(len(weights) - 1)
    for i in reversed(range(len(bounds))):
        part = F.when(u < F.lit(bounds[i]), F.lit(i)).otherwise(part)
    return df.withColumn(name, part.cast("int"))


def split_frames(df: DataFrame, flag: str = "is_train") -> tuple[DataFrame, DataFrame]:
    """(train, test) views of a flagged frame; both are filters of one plan."""
    return df.where(F.col(flag)), df.where(~F.col(flag))


def limit_n(df: DataFrame, n: int, order="date") -> DataFrame:
    """First ``n`` rows in ``order`` (O5); planned as a top-k, no global sort."""
    return df.orderBy(*as_list(order)).limit(n)


def subtract_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` not in ``b``, duplicates removed (O6), i.e. EXCEPT DISTINCT."""
    return a.subtract(b)


def test_dates(df: DataFrame, flag: str = "is_train", cols=("date",), by=()) -> DataFrame:
    """Dates of the test part."""
    return df.where(~F.col(flag)).select(*as_list(by), *cols)


_FIXED = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
          T.DateType, T.TimestampType, T.TimestampNTZType)


def _pick(df: DataFrame, by, order, largest: bool) -> DataFrame:
    by = as_list(by)
    rest = [c for c in df.columns if c not in by]
    orders = as_list(order)
    okey = F.col(orders[0]) if len(orders) == 1 else F.struct(*[F.col(o) for o in orders])
    pick = F.max_by if largest else F.min_by
    if len(orders) == 1 and all(isinstance(df.schema[c].dataType, _FIXED) for c in rest):
        # fixed-width values and order key: one max_by per column keeps the aggregation
        # hash-based (a struct value forces a sort aggregate); the order key must be unique per key
        aggs = [pick(F.col(c), okey).alias(c) for c in rest]
        return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    agg = pick(F.struct(*rest), okey).alias("_row")
    out = df.groupBy(*by).agg(agg) if by else df.agg(agg)
    return out.select(*by, "_row.*")


def latest(df: DataFrame, by=(), order="date") -> DataFrame:
    """The latest row of each key (O11); an aggregate, so a hot key is pre-reduced per task.

    The order value must be unique within a key (one row per date).
    """
    return _pick(df, by, order, largest=True)


def first_row(df: DataFrame, by=(), order="idx") -> DataFrame:
    """The earliest row of each key (O12), for example the first test row."""
    return _pick(df, by, order, largest=False)
