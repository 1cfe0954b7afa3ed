from pyspark.sql import functions as F

from conftest import SF01, rows
from tidecast.operators import profile, split
from tidecast.operators.scale import minmax, zscore, zscore_then_minmax
from tidecast.sources import fixtures as fx


def _split(spark):
    s = split.ordered_split(fx.bars_multi(spark, SF01), 0.8, "date", by="symbol")
    return s.select("symbol", "date", "idx", "is_train", "open", "close")


def test_zscore_then_minmax_equals_minmax(spark):
    s = _split(spark)
    a = minmax(s, ["open", "close"], by="symbol")
    b = zscore_then_minmax(s, ["open", "close"], by="symbol")
    ra = {(r.symbol, r.idx): (r.open, r.close) for r in a.collect()}
    for r in b.collect():
        x = ra[(r.symbol, r.idx)]
        assert abs(x[0] - r.open) < 1e-9 and abs(x[1] - r.close) < 1e-9


def test_train_range_is_unit_and_unkeyed_form(spark):
    s = _split(spark)
    m = profile.min_max(minmax(s, ["close"], by="symbol").where("is_train"), ["close"], by="symbol").collect()
    assert all(abs(r.min_close) < 1e-12 and abs(r.max_close - 1) < 1e-12 for r in m)
    one = minmax(s.where("symbol = '1-URGENT'"), ["close"])
    keyed = minmax(s.where("symbol = '1-URGENT'"), ["close"], by="symbol")
    assert rows(one) == rows(keyed)
    z = zscore(s, ["close"], by="symbol").where("is_train").groupBy("symbol").agg(
        F.avg("close").alias("m"), F.stddev_pop("close").alias("sd")).collect()
    assert all(abs(r.m) < 1e-9 and abs(r.sd - 1) < 1e-9 for r in z)


def test_constant_column(spark):
    df = spark.createDataFrame([(i, 5.0, i < 3) for i in range(5)], "idx int, x double, is_train boolean")
    assert [r.x for r in minmax(df, ["x"]).collect()] == [0.0] * 5
    h = profile.histogram(df, "x", 20).collect()
    assert [(r.bin, r.frequency) for r in h] == [(0, 5)]


def test_histogram_top_bin_and_clamp(spark):
    df = spark.range(0, 101).select(F.col("id").cast("double").alias("x"))
    h = {r.bin: r.frequency for r in profile.histogram(df, "x", 20).collect()}
    assert h[20] == 1 and sum(h.values()) == 101
    c = {r.bin: r.frequency for r in profile.histogram(df, "x", 20, clamp_last=True).collect()}
    assert max(c) == 19 and sum(c.values()) == 101


def test_null_profile_counts_nan(spark):
    df = spark.createDataFrame([(1.0, 1), (float("nan"), None), (None, 2)], "x double, n int")
    p = profile.null_profile(df).first()
    assert (p.x, p.n) == (2, 1)
    q = profile.null_count(df).first()
    assert (q.x, q.n) == (1, 1)
