"""Chunking: spread one long ordered series over many tasks.

A window over ``partitionBy(by)`` puts every row of a key into one task; with
no key it puts the whole table into one task. Chunking adds a coarse bucket of
the order column (for example the year) to the partition key. Work that must
cross bucket borders (the value carried into a bucket, the rows before it) is
computed on a per-bucket summary, which has one row per (key, bucket) and is
joined back. The summary is small and AQE broadcasts it when its measured
size is under the broadcast threshold; otherwise the join reuses the window's
partitioning, so the large side is not shuffled again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = "_chunk"

_UNITS = {
    "year": F.year,
    "month": lambda c: F.year(c) * 100 + F.month(c),
    "week": lambda c: F.date_trunc("week", c),
    "day": lambda c: F.to_date(c),
}


def chunk_expr(chunk, order_col: str) -> Column:
    """Bucket expression: a unit name applied to the first order column, or a Column.

    The bucket must be monotone in the order column.
    """
    if isinstance(chunk, Column):
        return chunk
    if chunk in _UNITS:
        return _UNITS[chunk](F.col(order_col))
    if isinstance(chunk, int):
        # fixed-width buckets of an integer order column (for example an index)
        return F.floor(F.col(order_col) / F.lit(chunk))
    raise ValueError(f"unknown chunk {chunk!r}")


def auto_chunk(df, by, order, chunk, buckets: int = 200):
    """The chunk to use: ``chunk`` if given; with no key, a default bucket of the order column. ``"even"`` cuts buckets
    that hold equally many rows from the data (``even_chunk``).

    A window with neither key nor chunk moves the whole table into one task,
    so an unkeyed call is always chunked: month buckets for dates, day buckets
    for timestamps, 2^20-wide buckets for integers, ranges cut at approximate
    quantiles of the data for doubles and decimals (found by one aggregation
    while the plan is built). Results are unchanged. Other order types have no bucket that
    is both monotone and even: they raise, asking for a key or a chunk.
    """
    if isinstance(chunk, str) and chunk == "even":
        return even_chunk(df, as_list(order)[0])
    if chunk is not None or as_list(by):
        return chunk
    first = as_list(order)[0]
    if isinstance(first, str):
        dt = df.schema[first].dataType.simpleString()
        if dt == "date":
            return "month"
        if dt.startswith("timestamp"):
            return "day"
        if dt in ("int", "bigint", "smallint", "tinyint"):
            return 1 << 20
        if dt in ("double", "float") or dt.startswith("decimal"):
            # NULL stays in a bucket of its own (first, as in the order), NaN falls into the last one
            x = F.col(first)
            edges = quantile_edges(df, first, buckets)
            return F.when(x.isNotNull(), F.size(F.filter(edges, lambda e: e < x)) if edges is not None else F.lit(0))
    raise ValueError(f"ordering a table without a key by {first!r} needs by= or chunk=: one task would get all rows")


def ntz_micros(t: Column) -> Column:
    """Wall-clock microseconds since the epoch from the wall-clock fields, which do not depend on the session zone (a
    cast to timestamp would, and collides in DST gaps)."""
    secs = F.date_part(F.lit("SECOND"), t)
    return (F.unix_date(F.to_date(t)).cast("long") * 86_400_000_000 + F.hour(t).cast("long") * 3_600_000_000
            + F.minute(t).cast("long") * 60_000_000 + (secs * 1_000_000).cast("long"))


#: Buckets that ``chunk="even"`` cuts the order column into.
EVEN = 1024


def even_chunk(df, col: str, buckets: int = EVEN) -> Column:
    """The bucket of ``col`` among ranges that hold about equally many rows of ``df`` each, over all keys: a group of
    (key, bucket) has at most a bucket's share of all rows and the ties at its end, however the rows are spread over keys
    and time. Cut at approximate quantiles, one aggregation over this column alone; NULL has a bucket of its own.

    Found in two steps, among every 32nd edge and then among the 32 that follow, as the edges are a literal of the plan."""
    cuts = [(i + 1) / buckets for i in range(buckets - 1)]
    kind = df.schema[col].dataType.simpleString()
    x = F.col(col)
    # dates and times have quantiles as numbers
    as_number = {"date": lambda c: F.unix_date(c), "timestamp": lambda c: F.unix_micros(c),
                 "timestamp_ntz": ntz_micros}.get(kind)
    if as_number:
        df, x = df.select(as_number(x).alias(col)), as_number(x)
    found = df.where(F.col(col).isNotNull()).agg(F.percentile_approx(col, cuts).alias("e")).first()["e"]
    edges = sorted(set(found or []))
    if not edges:
        return F.when(F.col(col).isNotNull(), F.lit(0))
    runs = [edges[i:i + 32] for i in range(0, len(edges), 32)]
    literal = lambda es: F.array(*[F.lit(e) for e in es])
    coarse = F.size(F.filter(literal([r[-1] for r in runs[:-1]]), lambda e: e < x)) if len(runs) > 1 else F.lit(0)
    fine = F.size(F.filter(F.element_at(F.array(*[literal(r) for r in runs]), coarse + 1), lambda e: e < x))
    return F.when(F.col(col).isNotNull(), coarse * 32 + fine)


def quantile_edges(df, col: str, buckets: int):
    """The inner ``buckets - 1`` approximate quantiles of a column as an array literal; None without any value."""
    cuts = [(i + 1) / buckets for i in range(buckets - 1)]
    edges = df.where(F.col(col).isNotNull()).agg(F.percentile_approx(col, cuts).alias("e")).first()["e"] if cuts else []
    return None if edges is None else F.array(*[F.lit(e) for e in edges]).cast(f"array<{df.schema[col].dataType.simpleString()}>")


KEY = "_key"


def key_struct(*cols) -> Column:
    """The columns as one struct. It is never NULL, and NULL fields are equal to NULL fields, so that windows,
    groups and joins over it treat NULL keys alike and share one partitioning."""
    return F.struct(*[F.col(c) if isinstance(c, str) else c for c in cols])


ROW = "_row"
#: How many of a bucket's rows there are, in its summary.
ROWS = "_rows"


def laid_out(df, by, order: str, chunk):
    """``df`` dealt by (key, bucket), the rows as one struct: columns KEY and ROW.

    What a bucket's rows get from each other and what the buckets hand on are computed from this one exchange. Spark reuses an
    exchange only if its readers need the same columns, so rows travel whole, and a summary (``summarized``) counts whole
    rows; the condition, which always holds, keeps the count from being replaced by one that needs no row."""
    row = F.when(F.hash(F.col(order)) >= F.lit(-(1 << 31)), F.struct(*[F.col(c) for c in df.columns]))
    return df.select(key_struct(*by, chunk_expr(chunk, order).alias(CHUNK)).alias(KEY), row.alias(ROW)).repartition(KEY)


def unpacked(ex, columns) -> list:
    """The rows' own columns out of ``laid_out``, by name."""
    return [F.col(f"{ROW}.`{c}`").alias(c) for c in columns]


def summarized(ex, by, *aggs):
    """One row per bucket of ``laid_out``: KEY, the key columns, CHUNK, ROWS and ``aggs``. A hash aggregate on the exchange
    that the rows themselves go through."""
    out = ex.groupBy(KEY).agg(F.count(ROW).alias(ROWS), *aggs).where(F.col(ROWS) > 0)
    return out.withColumns({**{b: F.col(f"{KEY}.`{b}`") for b in as_list(by)}, CHUNK: F.col(f"{KEY}.{CHUNK}")})


def join_on_keys(left, right, by, how: str = "left"):
    """``left.join(right, by, how)`` where a NULL key meets a NULL key."""
    by = as_list(by)
    rest = [c for c in right.columns if c not in by]
    keyed = right.select(key_struct(*by).alias(KEY), *rest)
    return left.withColumn(KEY, key_struct(*by)).join(keyed, KEY, how).select(*left.columns, *rest)


def as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def one_row(df) -> Column:
    """A one-row DataFrame as a single struct-valued scalar subquery.

    Reading several fields of it (``row["a"]``, ``row["b"]``) evaluates the
    subquery once, where one ``.scalar()`` per column would plan it per column.
    """
    return df.select(F.struct(*[F.col(c) for c in df.columns]).alias("_row")).scalar()
