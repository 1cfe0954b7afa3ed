"""Ridge regressions for many targets at once over windows of a series.

All targets share the windows, so one pass over the stored rows serves all of them: conjugate gradients keep a matrix of one column per
target, and each step is one distributed product with the windows, which are cut from blocks of rows where they are used.
Neither the windows nor the matrix of their features' products is ever made as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.operators._chunks import as_list, join_on_keys, one_row
from tidecast.operators.sequences import sequence_blocks


class WindowRidge:
    """Coefficients of all steps ahead: ``weights`` (features, steps) on standardized windows, their ``mean`` and ``scale``,
    ``target_mean``, and ``passes``, how often the windows were read."""

    def __init__(self, mean, scale, target_mean, weights, passes):
        self.mean, self.scale, self.target_mean, self.weights, self.passes = mean, scale, target_mean, weights, passes

    def predict(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights + self.target_mean


def window_blocks(df: DataFrame, cols: Sequence[str], window: int, stride: int, telescope: int, order="date", by=(),
                  idx: str = "idx", flag: str = "is_train") -> DataFrame:
    """``sequence_blocks`` of an indexed and split table, stored, with ``pad`` and ``cut``: the padding rows of the key and
    the index of its first test row, from which a window's part follows."""
    from tidecast.session import ensure_checkpoint_dir
    by = as_list(by)
    ensure_checkpoint_dir(df.sparkSession)
    blocks = sequence_blocks(df, cols, order, by, window, stride, telescope, idx=idx)
    ends = [F.count("*").alias("_n"), F.count_if(flag).alias("cut")]
    if by:
        blocks = join_on_keys(blocks, df.groupBy(*by).agg(*ends), by)
    else:
        row = one_row(df.agg(*ends))
        blocks = blocks.withColumns({"_n": row["_n"], "cut": row["cut"]})
    pad = F.pmod(F.lit(window) - F.pmod("_n", F.lit(window)), F.lit(window))
    return blocks.where("windows > 0").withColumn("pad", pad).drop("_n").checkpoint()


def _windows(row, window: int, stride: int, telescope: int, label: int, test: bool):
    """(starts, inputs as rows, labels) of the block's windows of one part: labels wholly in the train rows, or wholly in
    the test rows."""
    starts = row.first + stride * np.arange(row.windows)
    labels_at = starts + window - row.pad  # index of the first label row
    keep = labels_at >= row.cut if test else labels_at + telescope <= row.cut
    if not keep.any():
        return starts[:0], None, None
    values = np.stack(row.values).astype(float)
    at = row.offset + stride * np.arange(row.windows)[keep]
    view = np.lib.stride_tricks.sliding_window_view(values, window, axis=0)[at]  # windows, columns, rows
    return starts[keep], view.transpose(0, 2, 1).reshape(len(at), -1), values[at[:, None] + window + np.arange(telescope), label]


def _summed(blocks: DataFrame, part, width: int) -> np.ndarray:
    """The sum over all train windows of ``part(x, y)``, an array (rows, width). Each task adds its own up first; what comes
    to the driver has the model's size, whatever the number of windows."""
    spark = blocks.sparkSession
    cols = [f"s{i}" for i in range(width)]

    def run(batches):
        total = None
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                x = part(row)
                if x is not None:
                    total = x if total is None else total + x
        if total is not None:
            yield pd.DataFrame(total, columns=cols).assign(i=np.arange(len(total), dtype=np.int64))[["i", *cols]]

    tasks = max(1, min(spark.sparkContext.defaultParallelism, blocks.rdd.getNumPartitions()))
    sums = blocks.select("values", "first", "offset", "windows", "pad", "cut").coalesce(tasks).mapInPandas(
        run, "i long, " + ", ".join(f"{c} double" for c in cols))
    found = sums.groupBy("i").agg(*[F.sum(c).alias(c) for c in cols]).toPandas().sort_values("i")
    return found[cols].to_numpy(dtype=float)


def fit_window_ridge(blocks: DataFrame, window: int, stride: int, telescope: int, label: int, reg: float = 0.1,
                     tolerance: float = 1e-8, max_passes: int = 200) -> WindowRidge:
    """Ridge regression of each of the next ``telescope`` values of column ``label`` on the flattened window.

    Features are standardized (constant ones get no weight) and each target has MLlib's penalty for its own scale, so that
    the result equals MLlib's least squares with ``regParam=reg`` on every target. Conjugate gradients stop when all
    residuals are under ``tolerance`` of what they began with; if ``max_passes`` is met first an error is raised.
    """
    spark = blocks.sparkSession
    cut = lambda row: _windows(row, window, stride, telescope, label, test=False)[1:]

    def moments(row):
        x, y = cut(row)
        if x is None:
            return None
        z = np.concatenate([np.ones((len(x), 1)), x, y], axis=1)
        return np.stack([z.sum(axis=0), (z * z).sum(axis=0)], axis=1)

    found = _summed(blocks, moments, 2)
    if not len(found):
        raise ValueError("no window lies in the train rows")
    n = found[0, 0]
    mean = found[1:, 0] / n

    def spread(row):
        x, y = cut(row)
        return None if x is None else ((np.concatenate([x, y], axis=1) - sent.value) ** 2).sum(axis=0)[:, None]

    sent = spark.sparkContext.broadcast(mean)
    std = np.sqrt(_summed(blocks, spread, 1)[:, 0] / n)
    k = len(mean) - telescope
    mu, my, sy = mean[:k], mean[k:], std[k:]
    scale = np.where(std[:k] > 1e-12 * np.maximum(1, np.abs(mu)), std[:k], np.inf)
    penalty = np.divide(reg, sy, out=np.full(telescope, reg), where=sy > 0)

    def right(row):
        x, y = cut(row)
        return None if x is None else ((x - mu) / scale).T @ (y - my)

    def product(row):
        x, _ = cut(row)
        if x is None:
            return None
        x = (x - mu) / scale
        return x.T @ (x @ sent.value)

    r = _summed(blocks, right, telescope) / n
    w, p, passes = np.zeros_like(r), r.copy(), 3
    rr = (r * r).sum(axis=0)
    target = tolerance**2 * rr
    while (rr > target).any():
        if passes >= max_passes:
            raise ValueError(f"not solved within {max_passes} passes: residuals {np.sqrt(rr).max():.3g}")
        sent = spark.sparkContext.broadcast(p)
        ap = _summed(blocks, product, telescope) / n + p * penalty
        open_ = rr > target
        step = np.where(open_, rr / np.where(open_, (p * ap).sum(axis=0), 1), 0)
        w += step * p
        r -= step * ap
        new = (r * r).sum(axis=0)
        p = r + np.where(open_, new / np.where(open_, rr, 1), 0) * p
        rr, passes = new, passes + 1
        sent.unpersist()
    return WindowRidge(mu, scale, my, w, passes)


def predict_windows(model: WindowRidge, blocks: DataFrame, window: int, stride: int, telescope: int, label: int, by=()) -> DataFrame:
    """(by..., start, horizon, label, prediction) of all windows whose labels lie in the test rows."""
    by = as_list(by)
    sent = blocks.sparkSession.sparkContext.broadcast(model)
    names = {b: f"k{i}" for i, b in enumerate(by)}
    schema = T.StructType([*[T.StructField(names[b], blocks.schema[b].dataType) for b in by], T.StructField("start", T.LongType()),
                           T.StructField("horizon", T.IntegerType()), T.StructField("label", T.DoubleType()), T.StructField("prediction", T.DoubleType())])

    def run(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                starts, x, y = _windows(row, window, stride, telescope, label, test=True)
                if x is None:
                    continue
                out = pd.DataFrame({"start": np.repeat(starts, telescope), "horizon": np.tile(np.arange(1, telescope + 1, dtype=np.int32), len(starts)),
                                    "label": y.reshape(-1), "prediction": sent.value.predict(x).reshape(-1)})
                for c in names.values():
                    out[c] = getattr(row, c)
                yield out[[f.name for f in schema.fields]]

    rows = blocks.select(*[F.col(b).alias(c) for b, c in names.items()], "values", "first", "offset", "windows", "pad", "cut")
    out = rows.mapInPandas(run, schema)
    return out.select(*[F.col(c).alias(b) for b, c in names.items()], "start", "horizon", "label", "prediction")
