import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from tidecast.operators import explain, forecast, models
from tidecast.plans import catalog_models as cm


@pytest.fixture(scope="module")
def data(spark):
    train, test = cm._train_test(spark, SF01)
    return train.cache(), test.cache()


def test_grouped_linear_equals_lstsq(spark, data):
    train, _ = data
    feats = ["open", "high", "volume"]
    coefs = {r.symbol: r for r in models.fit_grouped_linear(train, feats, "close", "symbol").collect()}
    pdf = train.select("symbol", *feats, "close").toPandas()
    for sym, g in pdf.groupby("symbol"):
        X = np.column_stack([np.ones(len(g)), g[feats].to_numpy()])
        beta = np.linalg.lstsq(X, g["close"].to_numpy(), rcond=None)[0]
        r = coefs[sym]
        assert abs(r.intercept - beta[0]) < 1e-6 * max(1, abs(beta[0]))
        for j, f in enumerate(feats):
            assert abs(r[f"coef_{f}"] - beta[j + 1]) < 1e-6 * max(1, abs(beta[j + 1]))


def test_window_fit_equals_grouped(spark):
    p = cm.prepared_1f(spark, SF01)
    a = models.fit_predict_linear_window(p, "open", "close", "symbol").where("NOT is_train")
    c = models.fit_grouped_linear(p.where("is_train"), ["open"], "close", "symbol")
    b = models.predict_grouped_linear(c, p.where("NOT is_train"), ["open"], "symbol")
    ra = {(r.symbol, r.idx): r.prediction for r in a.collect()}
    for r in b.collect():
        assert abs(ra[(r.symbol, r.idx)] - r.prediction) < 1e-6


def test_mllib_lr_matches_closed_form_one_symbol(spark):
    p = cm.prepared_1f(spark, SF01).where("symbol = '1-URGENT'")
    m = models.fit(p.where("is_train"), "lr", ["open"], "close")
    got = models.linear_coefficients(m, ["open"])
    c = models.fit_grouped_linear(p.where("is_train"), ["open"], "close").first()
    assert abs(got["coef_open"] - c.coef_open) < 1e-6
    assert abs(got["intercept"] - c.intercept) < 1e-3


def test_importances_sum_to_one_and_reload(spark, data, tmp_path):
    train, test = data
    m = models.fit(train, "rf", cm.MODEL_FEATURES, "close", numTrees=3)
    imp = explain.importances(spark, m, cm.MODEL_FEATURES)
    assert abs(imp.agg(F.sum("importance")).first()[0] - 1.0) < 1e-9
    from tidecast.sources.sinks import load_model, save_model
    path = save_model(m, str(tmp_path / "rf"))
    a = models.predict(m, test).select("symbol", "idx", "prediction").collect()
    b = models.predict(load_model(path), test).select("symbol", "idx", "prediction").collect()
    assert sorted(a) == sorted(b)


def test_model_choice_rejects_unknown():
    with pytest.raises(ValueError):
        models.model_choice("lstm")


def test_lime_recovers_linear_coefficients(spark, data):
    train, test = data
    feats = ["open", "high", "low", "volume"]
    m = models.fit(train, "lr", feats, "close")
    truth = models.linear_coefficients(m, feats)
    rows = test.limit(3).withColumn("rid", F.col("idx"))
    w = explain.lime(m, train, rows, feats, row_id="rid", n_samples=200).where("feature != '(intercept)'")
    for r in w.collect():
        assert abs(r.weight - truth[f"coef_{r.feature}"]) < 1e-6 * max(1.0, abs(truth[f"coef_{r.feature}"]))


def test_shap_linear_sums_to_prediction_minus_mean(spark, data):
    train, test = data
    feats = ["open", "high", "volume"]
    coefs = models.fit_grouped_linear(train, feats, "close", "symbol")
    attr = explain.shap_linear(coefs, train, test, feats, "idx", by="symbol")
    tot = attr.groupBy("symbol", "idx").agg(F.sum("phi").alias("s"))
    pred = models.predict_grouped_linear(coefs, test, feats, "symbol").select("symbol", "idx", "prediction")
    mean = models.predict_grouped_linear(coefs, train, feats, "symbol").groupBy("symbol").agg(
        F.avg("prediction").alias("mf"))
    chk = tot.join(pred, ["symbol", "idx"]).join(mean, "symbol").select(
        F.max(F.abs(F.col("s") - (F.col("prediction") - F.col("mf")))).alias("err")).first()
    assert chk.err < 1e-5


def test_shap_sampled_efficiency_and_linear_case(spark, data):
    train, test = data
    feats = ["open", "high", "low"]
    bg = train.orderBy("symbol", "idx").limit(1).cache()
    rows = test.limit(4).withColumn("rid", F.col("idx").cast("string")).cache()
    # trees: with one background row every permutation sums to f(x) - f(b)
    m = models.fit(train, "rf", feats, "close", numTrees=5)
    phi = explain.shap_sampled(m, bg, rows, feats, row_id="rid", n_perm=6, seed=3)
    assert phi.count() == 4 * len(feats)
    s = {r.rid: r.s for r in phi.groupBy("rid").agg(F.sum("phi").alias("s")).collect()}
    fx_ = {r.rid: r.prediction for r in m.transform(rows).select("rid", "prediction").collect()}
    fb = m.transform(bg).first().prediction
    assert all(abs(s[k] - (fx_[k] - fb)) < 1e-6 for k in s)
    # linear model: sampled values equal the exact w_j * (x_j - b_j)
    lr = models.fit(train, "lr", feats, "close")
    w = models.linear_coefficients(lr, feats)
    b = bg.first()
    got = {(r.rid, r.feature): r.phi for r in explain.shap_sampled(lr, bg, rows, feats, "rid", 4).collect()}
    for r in rows.collect():
        for f in feats:
            assert abs(got[(r.rid, f)] - w[f"coef_{f}"] * (r[f] - b[f])) < 1e-4


def test_future_frame_and_carry(spark):
    p = cm.prepared_1f(spark, SF01)
    f = forecast.future_frame(p, 10, by="symbol")
    assert f.count() == 5 * 11
    c = forecast.carry_forward(p, 10, by="symbol")
    last = p.groupBy("symbol").agg(F.max("idx").alias("m")).collect()
    got = {r.symbol: r.idx for r in c.where("step = 10").collect()}
    assert all(got[r.symbol] == r.m + 10 for r in last)


def test_tune_time_folds(spark, data):
    train, _ = data
    best, table = models.tune(train, "rf", ["open", "high"], "close", grid={"numTrees": [2, 3]}, folds=2,
                              by="symbol", parallelism=2)
    assert table.count() == 2 and best is not None


def test_stream_equals_batch(spark):
    q = cm.q_score_new_bars(spark, SF01)
    b = cm.q_predict(spark, SF01)
    assert sorted(q.collect()) == sorted(b.collect())


def test_prepare_materialized_equals_lazy(spark):
    from tidecast.plans.flows import prepare
    from tidecast.sources import fixtures as fx
    bars = fx.bars_multi(spark, SF01).select("symbol", "date", "open", "close")
    a = prepare(bars, fx.series_wide(spark, SF01), ["m_monthly"], by="symbol")
    b = prepare(bars, fx.series_wide(spark, SF01), ["m_monthly"], by="symbol", materialize=True)
    assert sorted(a.collect()) == sorted(b.collect())


def test_stream_resumes_without_duplicates(spark, tmp_path):
    """A restarted availableNow query processes only files that arrived since, exactly once."""
    from tidecast.session import shared_path
    from tidecast.streaming.score import score_stream
    p, c = cm._coefs_1f(spark, SF01)
    arrived = p.where("NOT is_train").select("symbol", "idx", "date", "open", "close")
    landing = shared_path(spark, "landing-test")
    sink = str(tmp_path / "sink")
    arrived.where("idx % 2 = 0").write.mode("append").parquet(landing)
    kw = dict(coefs=c, by="symbol", sink_dir=sink, keep=["symbol", "idx", "date", "close"])
    score_stream(spark, landing, arrived.schema, ["open"], **kw)
    first = spark.read.parquet(sink).count()
    arrived.where("idx % 2 = 1").write.mode("append").parquet(landing)
    score_stream(spark, landing, arrived.schema, ["open"], **kw)
    out = spark.read.parquet(sink)
    assert first == arrived.where("idx % 2 = 0").count()
    assert out.count() == arrived.count()
    assert out.select("symbol", "idx").distinct().count() == arrived.count()


def test_predict_future_with_pipeline(spark, data):
    train, _ = data
    feats = ["open", "volume", "year", "month", "day", "fulldate"]
    m = models.fit(train, "lr", feats, "close")
    hist = cm.model_data(spark, SF01)
    fut = forecast.carry_forward(hist.drop("is_train"), 10, by="symbol")
    out = models.predict(m, fut)
    assert out.count() == 5 * 11
    r = out.where("step = 3").select("date", "year", "month", "day", "fulldate").collect()
    assert all(x.fulldate == x.date.year * 10000 + x.date.month * 100 + x.date.day for x in r)
    assert out.where(F.col("prediction").isNull()).count() == 0


def test_lime_quartile_properties(spark, data):
    train, test = data
    feats = ["open", "high", "low", "volume", "m_monthly", "m_weekly", "m_daily", "year"]
    m = models.fit(train, "rf", feats, "close", numTrees=3)
    rows = test.limit(3).withColumn("rid", F.col("idx"))
    a = explain.lime_quartile(m, train, rows, feats, row_id="rid", n_samples=400, num_features=5)
    got = a.collect()
    # more than six features and more than num_features: the top five are kept per row
    assert len(got) == 3 * 5
    vals = {r.rid: r for r in rows.collect()}
    for r in got:
        x = vals[r.rid][r.feature]
        cond = r.condition
        if cond.startswith(f"{r.feature} <= "):
            assert x <= float(cond.split("<= ")[1]) + 0.005
        elif cond.startswith(f"{r.feature} > "):
            assert x > float(cond.split("> ")[1]) - 0.005
        else:
            lo, hi = float(cond.split(" < ")[0]), float(cond.split("<= ")[1])
            assert lo - 0.005 < x <= hi + 0.005
    # re-evaluation on a different partitioning gives the same numbers
    b = explain.lime_quartile(m, train.repartition(3), rows.repartition(2), feats, row_id="rid", n_samples=400,
                              num_features=5)
    assert sorted(got) == sorted(b.collect())


def test_stream_with_mllib_model_equals_batch(spark, data, tmp_path):
    from tidecast.streaming.score import score_stream
    train, test = data
    feats = ["open", "high", "low"]
    m = models.fit(train, "rf", feats, "close", numTrees=3)
    landing = str(tmp_path / "landing")
    arrived = test.select("symbol", "idx", "date", *feats, "close")
    arrived.write.parquet(landing)
    out_dir, _q = score_stream(spark, landing, arrived.schema, feats, model=m, by="symbol",
                               sink_dir=str(tmp_path / "sink"), keep=["symbol", "idx"])
    got = sorted(spark.read.parquet(out_dir).collect())
    want = sorted(models.predict(m, arrived).select("symbol", "idx", "prediction").collect())
    assert got == want


def test_tune_expanding_and_random(spark, data):
    train, _ = data
    best, table = models.tune(train, "rf", ["open", "high"], "close", grid={"maxDepth": [2, 4]}, folds=3,
                              fold="expanding", by="symbol")
    assert table.count() == 2 and best is not None
    assert {r.params for r in table.collect()} == {"maxDepth=2", "maxDepth=4"}
    best2, table2 = models.tune(train, "lr", ["open"], "close", grid={"regParam": [0.0, 1.0]}, folds=2,
                                fold="random")
    assert table2.count() == 2


def test_gbt_importances_and_registry_defaults(spark, data):
    train, _ = data
    feats = ["open", "high", "low"]
    m = models.fit(train, "gbt", feats, "close", maxIter=3)
    imp = explain.importances(spark, m, feats, "gbt").collect()
    assert abs(sum(r.importance for r in imp) - 1.0) < 1e-9 and {r.model for r in imp} == {"gbt"}
    lr = models.fit(train, "lr", feats, "close")
    with pytest.raises(ValueError):
        explain.importances(spark, lr, feats)
    assert models.model_choice("rf").getNumTrees() == 3
    assert models.model_choice("gbt").getMaxIter() == 20
    assert models.model_choice("lr").getRegParam() == 0.0


def test_r2_constant_target(spark):
    df = spark.createDataFrame([("a", 1.0, 1.1), ("a", 1.0, 0.9), ("b", 2.0, 2.0), ("b", 2.0, 2.0)],
                               "symbol string, close double, prediction double")
    got = {r.symbol: r.r2 for r in models.evaluate(df, "r2", by="symbol").collect()}
    assert got == {"a": 0.0, "b": 1.0}


def test_search_counts_its_fits(spark, data):
    train, _ = data
    fits = []
    models.tune(train, "rf", ["open"], "close", grid={"maxDepth": [1, 2]}, folds=4, by="symbol", on_fit=fits.append)
    assert sorted(fits) == ["maxDepth=1"] * 3 + ["maxDepth=2"] * 3
