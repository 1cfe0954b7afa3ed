"""Fixed-length sequences for sequence models.

No step puts a whole series into one task: every output row (one window)
gathers exactly ``window + telescope`` elements, so groups are bounded by the
window size whatever the length of the series or the skew between keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.operators._chunks import as_list, join_on_keys, one_row
from tidecast.operators.index import row_index


def _values(cols) -> F.Column:
    return F.array(*[F.col(c).cast("double") for c in cols])


def sequence_blocks(df: DataFrame, cols: Sequence[str], order="date", by=(), window: int = 200, stride: int = 20,
                    telescope: int = 1, idx: str | None = None, chunk=None) -> DataFrame:
    """The padded rows that the windows of ``build_sequences`` are cut from, in blocks: about four spans of positions and a
    halo of one span, so that every window lies within one block and a row is in two blocks at most.

    Output: ``by..., values array<array<double>>`` (rows in order of position), ``first`` (start of the first window),
    ``offset`` (place of its first row in ``values``) and ``windows``, their number, each ``stride`` after the one before."""
    if window % stride:
        raise ValueError("window must be a multiple of stride")
    by = as_list(by)
    cols = list(cols)
    span = window + telescope
    if idx is None:
        df = row_index(df, order, by, name="_idx", chunk=chunk)
        idx = "_idx"
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")) if by else \
        df.agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_pad", F.pmod(F.lit(window) - F.pmod("_n", F.lit(window)), F.lit(window)))
    # number of starts: ceil((P - window - telescope) / stride), at least 0
    counts = counts.withColumn(
        "_kmax", F.greatest(F.ceil((F.col("_n") + F.col("_pad") - F.lit(span)) / F.lit(stride)), F.lit(0)) - 1)
    keys = counts.select(*by, "_pad", "_kmax")
    real = df.select(*by, F.col(idx).alias("_i"), _values(cols).alias("_v"))
    if by:
        real = join_on_keys(real, keys, by, "inner")
    else:
        k = one_row(keys)
        real = real.withColumns({"_pad": k["_pad"], "_kmax": k["_kmax"]})
    real = real.select(*by, (F.col("_i") + F.col("_pad")).alias("_p"), "_v", "_kmax")
    zeros = F.array(*[F.lit(0.0) for _ in cols])
    pad_rows = keys.where(F.col("_pad") > 0).select(
        *by, F.explode(F.sequence(F.lit(0).cast("long"), (F.col("_pad") - 1).cast("long"))).alias("_p"),
        zeros.alias("_v"), "_kmax")
    rows = real.select(*by, F.col("_p").cast("long").alias("_p"), "_v", "_kmax").unionByName(pad_rows)
    # buckets of positions: a bucket makes all windows that start in it, and so needs its own rows and a halo of
    # the rows after it; each row crosses the shuffle once, and once more if it lies in a halo
    size = stride * max(1, -(-4 * span // stride))
    blo = F.greatest(F.lit(0).cast("long"), F.ceil((F.col("_p") - F.lit(span - 1 - stride)) / F.lit(size)) - 1)
    bhi = F.least(F.floor(F.col("_p") / F.lit(size)), F.floor(F.col("_kmax") * stride / F.lit(size)))
    rows = rows.where((F.col("_kmax") >= 0) & (blo <= bhi)).select(
        *by, "_p", "_v", "_kmax", F.explode(F.sequence(blo.cast("long"), bhi.cast("long"))).alias("_b"))
    g = rows.groupBy(*by, "_b", "_kmax").agg(F.array_sort(F.collect_list(F.struct("_p", "_v"))).alias("_es"))
    first = F.col("_b") * F.lit(size // stride)
    last = F.least(F.col("_kmax"), first + F.lit(size // stride - 1))
    return g.select(*by, F.transform("_es", lambda e: e["_v"]).alias("values"), (first * stride).cast("long").alias("first"),
                    (first * stride - F.col("_b") * size).cast("int").alias("offset"), (last - first + 1).cast("int").alias("windows"))


def build_sequences(df: DataFrame, cols: Sequence[str], order="date", by=(), window: int = 200,
                    stride: int = 20, telescope: int = 1, idx: str | None = None, chunk=None) -> DataFrame:
    """Sliding windows of ``window`` rows as input and the next ``telescope`` rows as label.

    Semantics of the array form: the series is padded with zero rows in front
    to a multiple of ``window``; starts are 0, stride, ... strictly below
    ``padded_length - window - telescope`` (the last valid start is left out).
    Requires ``window % stride == 0``.

    Plan: positions are cut into buckets of about four spans; each row goes to
    its bucket and, if it lies in the halo after another one, to that one too.
    Padding rows are generated per key from its count, and ``groupBy(key,
    bucket)`` collects at most five spans of rows, ordered by position with
    ``array_sort``, never relying on ``collect_list`` order; the windows are
    slices of that array.

    Output: ``by..., start, inputs array<array<double>>, labels array<array<double>>``.
    """
    by = as_list(by)
    g = sequence_blocks(df, cols, order, by, window, stride, telescope, idx, chunk)
    g = g.where("windows > 0").select(*by, "values", "first", "offset", F.explode(F.sequence(F.lit(0), F.col("windows") - 1)).alias("_k"))
    at = F.col("offset") + F.col("_k") * stride
    return g.select(*by, (F.col("first") + F.col("_k") * stride).cast("long").alias("start"),
                    F.slice("values", at + 1, F.lit(window)).alias("inputs"),
                    (F.slice("values", at + 1 + window, F.lit(telescope)) if telescope > 0 else
                     F.array().cast("array<array<double>>")).alias("labels"))


def sequences_long(seqs: DataFrame, cols: Sequence[str], by=(), anchor: str = "start") -> DataFrame:
    """One row per element: ``by..., anchor, part ('input'|'label'), step, <cols>``."""
    by = as_list(by)
    parts = []
    for part, arr in (("input", "inputs"), ("label", "labels")):
        e = seqs.select(*by, anchor, F.posexplode(arr).alias("step", "_v"))
        parts.append(e.select(*by, anchor, F.lit(part).alias("part"), F.col("step").cast("long").alias("step"),
                              *[F.col("_v")[i].alias(c) for i, c in enumerate(cols)]))
    return parts[0].unionByName(parts[1])


def single_step_sequences(df: DataFrame, cols: Sequence[str], name: str = "seq") -> DataFrame:
    """Each row as a sequence of length one: ``array(array(cols))``."""
    return df.withColumn(name, F.array(_values(cols)))


def rolling_frame_sequences(df: DataFrame, cols: Sequence[str], order="date", by=(), window: int = 20,
                            telescope: int = 1, complete: bool = True, bucket_rows: int | None = None,
                            chunk=None) -> DataFrame:
    """Input = this row and the ``window - 1`` before it, label = the next ``telescope`` rows.

    Row frames of ``collect_list``: bounded per row by the frame width, and
    ordered, because a window frame is evaluated over sorted rows.
    ``complete`` keeps only rows whose frames are full.

    ``bucket_rows`` splits each key into buckets of that many consecutive rows
    (by a dense index, itself computed with ``chunk`` if given). Each bucket
    also receives copies of the ``window - 1`` rows before it and the
    ``telescope`` rows after it as context, so frames that cross a bucket
    border are exact while no task holds more than
    ``bucket_rows + window + telescope`` rows of a key.
    """
    by = as_list(by)
    vals = _values(cols)
    if bucket_rows is None and not by:
        bucket_rows = 1 << 16  # no key: never one task for the whole table
    if bucket_rows is None:
        w = Window.partitionBy(*by).orderBy(*[F.col(o) for o in as_list(order)])
        out = df.withColumns({
            "inputs": F.collect_list(vals).over(w.rowsBetween(-(window - 1), 0)),
            "labels": F.collect_list(vals).over(w.rowsBetween(1, telescope)) if telescope > 0
            else F.array().cast("array<array<double>>"),
        })
    else:
        if bucket_rows < max(window - 1, telescope):
            raise ValueError("bucket_rows must be at least max(window - 1, telescope)")
        idx = row_index(df, order, by, name="_ri", chunk=chunk)
        b = F.floor(F.col("_ri") / F.lit(bucket_rows))
        pos = F.col("_ri") - b * bucket_rows
        own = idx.withColumns({"_b": b, "_own": F.lit(True)})
        # the last window - 1 rows of a bucket are context for the next bucket
        after = idx.where(pos >= bucket_rows - (window - 1)).withColumns({"_b": b + 1, "_own": F.lit(False)})
        parts = own.unionByName(after)
        if telescope > 0:
            # the first telescope rows of a bucket are look-ahead for the previous one
            before = idx.where((pos < telescope) & (b > 0)).withColumns({"_b": b - 1, "_own": F.lit(False)})
            parts = parts.unionByName(before)
        w = Window.partitionBy(*by, "_b").orderBy("_ri")
        out = parts.withColumns({
            "inputs": F.collect_list(vals).over(w.rowsBetween(-(window - 1), 0)),
            "labels": F.collect_list(vals).over(w.rowsBetween(1, telescope)) if telescope > 0
            else F.array().cast("array<array<double>>"),
        }).where("_own").select(*df.columns, "inputs", "labels")
    if complete:
        out = out.where((F.size("inputs") == window) & (F.size("labels") == telescope))
    return out
