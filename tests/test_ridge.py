"""Ridge by conjugate gradients over windows against MLlib, one model per step."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.operators import forecast, ridge, sequences
from tidecast.operators.index import row_index
from tidecast.operators.split import ordered_split


@pytest.fixture(scope="module")
def table(spark):
    n = 150
    df = spark.range(2 * n).select(F.when(F.col("id") < n, "a").alias("symbol"), F.pmod("id", F.lit(n)).alias("date"),
                                   (F.sin(F.col("id") / 7) + (F.xxhash64("id") % 100) / 400.0).alias("x"), (F.cos(F.col("id") / 5) + (F.hash("id") % 50) / 300.0).alias("y"))
    return ordered_split(row_index(df, "date", by="symbol"), 0.8, "date", by="symbol").checkpoint()  # the other symbol is NULL


def test_equals_mllib_step_by_step(table):
    cols, args = ["x", "y"], (10, 5, 3)
    blocks = ridge.window_blocks(table, cols, *args, by="symbol")
    m = ridge.fit_window_ridge(blocks, *args, label=0, reg=0.05)
    assert m.passes < 40 and m.weights.shape == (20, 3)
    got = {(r.symbol, r.start, r.horizon): (r.label, r.prediction) for r in ridge.predict_windows(m, blocks, *args, 0, by="symbol").collect()}
    seqs = sequences.build_sequences(table, cols, "date", "symbol", 10, 5, 3, idx="idx")
    first = F.col("start") + 10  # 150 rows need no padding
    seqs = seqs.withColumns({"_fit": first + 3 <= 120, "_test": first >= 120}).where("_fit OR _test")
    _m, preds = forecast.fit_horizons(seqs, 0, 3, kind="lr", by="symbol", fit_on=F.col("_fit"), regParam=0.05, solver="normal")
    want = {(r.symbol, r.start, r.horizon): (r.label, r.prediction) for r in preds.collect()}
    assert got.keys() == want.keys() and len(got) == 36
    assert np.allclose([got[k] for k in want], list(want.values()), atol=1e-6)


def test_padding_and_one_series_without_a_key(spark):
    df = spark.range(47).select(F.col("id").alias("date"), F.sin(F.col("id") / 3).alias("x"), F.lit(1.0).alias("c"))
    t = ordered_split(row_index(df, "date", chunk=100), 0.8, "date").checkpoint()
    blocks = ridge.window_blocks(t, ["x", "c"], 6, 3, 2)
    m = ridge.fit_window_ridge(blocks, 6, 3, 2, label=0, reg=0.01)
    assert np.isfinite(m.weights).all() and (m.weights[3::2] == 0).all()  # constant but for the padding of the first window
    out = ridge.predict_windows(m, blocks, 6, 3, 2, 0).collect()
    assert len(out) == 2 * len({r.start for r in out}) > 0
    # one row of padding: the label of the window that starts at s with step h is row s + 6 + h - 1 - 1
    assert all(abs(r.label - np.sin((r.start + 6 + r.horizon - 2) / 3)) < 1e-12 for r in out)


def test_no_train_window_and_too_few_passes_raise(table):
    blocks = ridge.window_blocks(table.withColumn("is_train", F.lit(False)), ["x"], 10, 5, 3, by="symbol")
    with pytest.raises(ValueError, match="no window"):
        ridge.fit_window_ridge(blocks, 10, 5, 3, 0)
    blocks = ridge.window_blocks(table, ["x", "y"], 10, 5, 3, by="symbol")
    with pytest.raises(ValueError, match="not solved"):
        ridge.fit_window_ridge(blocks, 10, 5, 3, 0, max_passes=5)
