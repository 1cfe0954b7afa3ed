"""NULL keys, NULL times, NaN and non-date times: chunked = plain = SQL."""

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tidecast.operators import explain, fill, forecast, index, joins, models, profile, scale, sequences, split

DAY = dt.date(2020, 1, 1)


def frame(spark, data):
    return spark.createDataFrame(data, "symbol string, date date, v double")


@st.composite
def keyed_series(draw):
    out = []
    for key in draw(st.lists(st.sampled_from(["a", "b", None]), min_size=1, max_size=3, unique=True)):
        days = draw(st.lists(st.integers(0, 900), min_size=1, max_size=12, unique=True))
        if draw(st.booleans()):
            days.append(None)
        for d in days:
            v = draw(st.sampled_from([None, 1.0, 2.5, -3.0, float("nan")]))
            out.append((key, None if d is None else DAY + dt.timedelta(days=d), v))
    return out


SLOW = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@given(keyed_series())
@SLOW
def test_chunked_equals_plain(spark, data):
    df = frame(spark, data)
    for fn in (fill.forward_fill, fill.backward_fill, fill.ffill_bfill, fill.lag_fill, fill.lead_fill):
        assert rows(fn(df, "v", "date", by="symbol", chunk="year")) == rows(fn(df, "v", "date", by="symbol")), fn.__name__
    assert rows(index.row_index(df, "date", "symbol", count="n", chunk="month")) == rows(index.row_index(df, "date", "symbol", count="n"))
    assert rows(split.ordered_split(df, 0.6, "date", "symbol", chunk="year")) == rows(split.ordered_split(df, 0.6, "date", "symbol"))
    assert rows(split.tail_split(df, 2, "date", "symbol", chunk="year")) == rows(split.tail_split(df, 2, "date", "symbol"))


def test_unkeyed_index_with_null_time(spark):
    df = frame(spark, [("a", None, 1.0), ("a", DAY, 2.0), ("a", DAY + dt.timedelta(days=400), 3.0)])
    assert sorted((r.v, r.idx) for r in index.row_index(df, "date").collect()) == [(1.0, 0), (2.0, 1), (3.0, 2)]


@pytest.mark.parametrize("kind", ["double", "decimal(10,2)"])
def test_unkeyed_order_by_numbers(spark, kind):
    data = [(float(x), ) for x in (5.5, 1.25, 3.75, 2.0, 9.0, -4.0)] + [(None,)]
    df = spark.createDataFrame(data, "t double").select(F.col("t").cast(kind).alias("t"))
    out = index.row_index(df, "t")
    assert [None if r.t is None else float(r.t) for r in out.orderBy("idx").collect()] == [None, -4.0, 1.25, 2.0, 3.75, 5.5, 9.0]


def test_unkeyed_order_without_buckets_is_refused(spark):
    df = spark.createDataFrame([("x", 1)], "t string, v int")
    with pytest.raises(ValueError):
        index.row_index(df, "t")
    with pytest.raises(ValueError):
        fill.forward_fill(df, "v", F.col("t"))


def asof_slow(left, right):
    out = []
    for k, t, x in left:
        best = [r for r in right if r[0] == k and r[0] is not None and r[1] is not None and t is not None and r[1] <= t and r[2] is not None]
        out.append((k, t, x, max(best, key=lambda r: r[1])[2] if best else None))
    return out


@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 60)), st.integers(0, 9)), max_size=12),
       st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 60)), st.integers(0, 9)), max_size=12,
                unique_by=lambda r: (r[0], r[1])), st.sampled_from(["double", "date", "int"]))
@SLOW
def test_asof_equals_sql(spark, left, right, kind):
    ls = spark.createDataFrame(left, "symbol string, i int, x int")
    rs = spark.createDataFrame(right, "symbol string, i int, w int")
    time = {"double": F.col("i") / 7.0, "date": F.date_add(F.lit(DAY), F.col("i")), "int": F.col("i")}[kind]
    ls, rs = ls.withColumn("t", time), rs.withColumn("t", time)
    got = joins.asof_join(ls, rs.select("symbol", "t", "w"), on="t", by="symbol").select("symbol", "i", "x", "w")
    assert rows(got) == sorted(asof_slow(left, right), key=lambda t: tuple((x is None, str(x)) for x in t))
    chunked = joins.asof_join(ls, rs.select("symbol", "t", "w"), on="t", by="symbol",
                              chunk={"double": F.floor(F.col("_t") * 2), "date": "month", "int": 7}[kind]).select("symbol", "i", "x", "w")
    assert rows(chunked) == rows(got)


def test_asof_does_not_look_ahead(spark):
    left = spark.createDataFrame([(1.2,)], "t double")
    right = spark.createDataFrame([(1.7, 5), (1.1, 4)], "t double, v int")
    assert [r.v for r in joins.asof_join(left, right, on="t").collect()] == [4]


def test_sequences_keep_null_keys(spark):
    data = [(k, DAY + dt.timedelta(days=i), float(i)) for k in ("a", None) for i in range(24)]
    s = sequences.build_sequences(frame(spark, data), ["v"], "date", "symbol", window=6, stride=2, telescope=1)
    by = {}
    for r in s.collect():
        by.setdefault(r.symbol, []).append((r.start, [x[0] for x in r.inputs], [x[0] for x in r.labels]))
    assert sorted(by["a"]) == sorted(by[None]) and len(by["a"]) == 9
    assert sorted(by["a"])[3] == (6, [6.0, 7.0, 8.0, 9.0, 10.0, 11.0], [12.0])


@pytest.mark.parametrize("n,window,stride,telescope", [(97, 12, 4, 3), (12, 12, 4, 3), (15, 12, 12, 0), (200, 20, 5, 2), (3, 6, 2, 1), (61, 4, 1, 9)])
def test_sequences_against_slices(spark, n, window, stride, telescope):
    data = [("a", DAY + dt.timedelta(days=i), float(i + 1)) for i in range(n)]
    got = {r.start: ([x[0] for x in r.inputs], [x[0] for x in r.labels]) for r in sequences.build_sequences(
        frame(spark, data), ["v"], "date", "symbol", window=window, stride=stride, telescope=telescope).collect()}
    padded = [0.0] * (-n % window) + [float(i + 1) for i in range(n)]
    want = {s: (padded[s:s + window], padded[s + window:s + window + telescope])
            for s in range(0, max(0, len(padded) - window - telescope), stride)}
    assert got == want


def test_rolling_frames_with_null_time(spark):
    data = [("a", None if i == 0 else DAY + dt.timedelta(days=40 * i), float(i)) for i in range(8)]
    df = frame(spark, data)
    plain = sequences.rolling_frame_sequences(df, ["v"], "date", "symbol", window=3, telescope=1)
    cut = sequences.rolling_frame_sequences(df, ["v"], "date", "symbol", window=3, telescope=1, bucket_rows=3, chunk="year")
    assert rows(plain) == rows(cut) and plain.count() == 5


def test_scaling(spark):
    df = spark.createDataFrame([(None, 1.0, True), (None, 3.0, True), (None, 5.0, False), ("a", 2.0, True), ("a", float("nan"), True), ("a", 4.0, True)],
                               "symbol string, v double, is_train boolean")
    got = sorted((str(r.symbol), str(r.v)) for r in scale.minmax(df, "v", by="symbol").collect())
    assert got == [("None", "0.0"), ("None", "1.0"), ("None", "2.0"), ("a", "0.0"), ("a", "1.0"), ("a", "nan")]
    z = [r.v for r in scale.zscore(df.where("symbol IS NULL"), "v", by="symbol").collect()]
    assert sorted(z) == [-1.0, 1.0, 3.0]
    for by in ((), "symbol"):
        back = scale.inverse_minmax(scale.minmax(df, "v", by=by), "v", df, by=by)
        assert rows(back) == rows(df)


def test_histogram(spark):
    df = spark.createDataFrame([(None, float(i)) for i in range(5)] + [(None, float("nan")), (None, None), ("a", 7.0), ("a", float("nan"))], "symbol string, close double")
    assert sorted((r.bin, r.frequency) for r in profile.histogram(df.where("symbol IS NULL"), bins=4).collect()) == [(0, 1), (1, 1), (2, 1), (3, 1), (4, 1)]
    got = sorted((str(r.symbol), r.bin, r.frequency) for r in profile.histogram(df, bins=4, by="symbol", edges=True).collect())
    assert got == [("None", 0, 1), ("None", 1, 1), ("None", 2, 1), ("None", 3, 1), ("None", 4, 1), ("a", 0, 1)]


def test_grouped_fit_masks_incomplete_rows(spark):
    df = spark.createDataFrame([(None, 1.0, 2.0), (None, 2.0, 4.0), (None, 3.0, 6.0), (None, None, 100.0), (None, float("nan"), 5.0), ("a", None, 1.0)],
                               "symbol string, x double, y double")
    c = {r.symbol: r for r in models.fit_grouped_linear(df, ["x"], "y", "symbol").collect()}
    assert c[None].n == 3 and c[None].intercept == pytest.approx(0, abs=1e-12) and c[None].coef_x == pytest.approx(2)
    p = models.predict_grouped_linear(models.fit_grouped_linear(df, ["x"], "y", "symbol"), df, ["x"], "symbol")
    assert sorted(r.prediction for r in p.where("x < 9 AND NOT isnan(x)").collect()) == pytest.approx([2, 4, 6])
    two = df.withColumn("z", F.col("x") * F.col("x"))
    assert models.fit_grouped_linear(two, ["x", "z"], "y", "symbol").first().n == 3


def test_metrics_leave_unscored_rows_out(spark):
    df = spark.createDataFrame([(1.0, 1.1), (2.0, 1.9), (3.0, 3.2), (1e6, None), (None, 3.0)], "close double, prediction double")
    scored = df.dropna()
    assert models.evaluate(df, ["rmse", "r2", "mae", "mse"]).first() == models.evaluate(scored, ["rmse", "r2", "mae", "mse"]).first()


def test_explanations_and_tables_keep_null_keys(spark):
    df = spark.createDataFrame([(None, 0, 1.0, 2.0, DAY), (None, 1, 2.0, 4.0, DAY), ("a", 0, 1.0, 3.0, DAY)], "symbol string, idx long, x double, close double, date date")
    c = models.fit_grouped_linear(df, ["x"], "close", "symbol")
    phi = explain.shap_linear(c, df, df, ["x"], "idx", "symbol")
    assert sorted(r.phi for r in phi.where("symbol IS NULL").collect()) == [-1.0, 1.0]
    t = forecast.forecast_table(df, df.withColumn("prediction", F.col("close")), "symbol")
    assert t.where("prediction IS NULL").count() == 0


def test_num_features_is_obeyed(spark):
    from tidecast.operators.models import fit
    data = [(i, float(i % 7), float(i % 5), float(i % 3), float(i % 11), 3.0 * (i % 7) - 2.0 * (i % 5)) for i in range(400)]
    df = spark.createDataFrame(data, "row_id long, a double, b double, c double, d double, close double")
    m = fit(df, "lr", ["a", "b", "c", "d"], "close")
    two = explain.lime_quartile(m, df, df.limit(3), ["a", "b", "c", "d"], row_id="row_id", num_features=2, n_samples=400)
    by = {}
    for r in two.collect():
        by.setdefault(r.row_id, set()).add(r.feature)
    assert len(by) == 3 and all(len(f) == 2 for f in by.values())
    assert {"a", "b"} == by[0]  # in the lowest bins of both features that the model uses
    assert explain.lime_quartile(m, df, df.limit(2), ["a", "b", "c", "d"], row_id="row_id", num_features=9, n_samples=200).count() == 8


def test_normal_quantile(spark):
    from statistics import NormalDist
    us = [1e-12, 1e-6, 0.01, 0.0749, 0.0751, 0.3, 0.5, 0.6, 0.925, 0.99, 1 - 1e-9]
    got = spark.createDataFrame([(u,) for u in us], "u double").withColumn("r", explain._tail(F.col("u"))).select("u", explain.normal_quantile("u", "r").alias("z")).collect()
    for r in got:
        assert math.isclose(r.z, NormalDist().inv_cdf(r.u), rel_tol=1e-9, abs_tol=1e-12)


def test_date_folds_hold_for_all_keys(spark):
    data = [(s, DAY + dt.timedelta(days=i), 1.0) for s, n in (("a", 50), ("b", 200)) for i in range(n)]
    f = models.date_folds(frame(spark, data), 4).groupBy("fold").agg(F.min("date").alias("lo"), F.max("date").alias("hi")).orderBy("fold").collect()
    assert len(f) == 4 and all(x.hi < y.lo for x, y in zip(f, f[1:]))


def test_reference_search_builds_all_fits(spark, monkeypatch):
    """9 settings x 30 random folds, counted without growing 270 forests."""
    from pyspark.ml.tuning import CrossValidator
    seen = {}

    def counted(self, data):
        seen["fits"] = len(self.getEstimatorParamMaps()) * self.getNumFolds()
        raise StopIteration
    monkeypatch.setattr(CrossValidator, "fit", counted)
    df = spark.createDataFrame([(1.0, 2.0, DAY)], "x double, close double, date date")
    with pytest.raises(StopIteration):
        models.tune(df, "rf", ["x"], grid=models.REFERENCE_RF_GRID, folds=models.REFERENCE_FOLDS, fold="random")
    assert seen["fits"] == 270


def test_many_features_fit(spark):
    """More features than the normal equations allow."""
    df = spark.range(30).select(F.transform(F.sequence(F.lit(0), F.lit(4199)), lambda j: F.sin(F.col("id") * (j + 1))).alias("a"), F.col("id").cast("double").alias("y"))
    from pyspark.ml.functions import array_to_vector
    est = models.model_choice("lr", labelCol="y", maxIter=3, regParam=0.1)
    assert est.fit(df.select(array_to_vector("a").alias("features"), "y")).numFeatures == 4200


def test_scratch_folder_only_on_local_masters():
    from tidecast.session import ensure_checkpoint_dir

    class Conf:
        def __init__(self, master):
            self.d = {"spark.master": master}

        def get(self, k, default=None):
            return self.d.get(k, default)

    class Session:
        def __init__(self, master):
            self.conf = Conf(master)
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session("yarn"))
