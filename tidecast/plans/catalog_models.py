"""Registered queries for sequences, models, explanations, forecasts, sinks and streaming.

Items checked by SQL use one feature (``open``) and a least-squares model per
symbol, which DuckDB expresses with ``regr_slope`` / ``regr_intercept``.
Tree models, hashing-based sampling and MLlib objects have no SQL form; they
are registered without oracle text and covered by property tests.
"""

from __future__ import annotations

import datetime
import os

from pyspark.ml import Pipeline
from pyspark.ml.feature import Interaction, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidecast.functions import calendar as cal
from tidecast.operators import explain, forecast, models, ridge, sequences, trees
from tidecast.operators._chunks import join_on_keys
from tidecast.operators.fill import forward_fill, lag_features
from tidecast.operators.index import row_index, symbol_index
from tidecast.operators.joins import enrich
from tidecast.operators.profile import drop_missing
from tidecast.operators.scale import inverse_minmax, minmax
from tidecast.operators.split import first_row, ordered_split
from tidecast.plans.catalog import _IDX, _ff_sql, register
from tidecast.plans.flows import prepare
from tidecast.plans.oracle import with_views
from tidecast.plans.sqlview import sql_view
from tidecast.session import ensure_checkpoint_dir, shared_path
from tidecast.sources import fixtures as fx
from tidecast.sources.sinks import load_model, save_model, write_predictions
from tidecast.streaming.prepare import prepare_and_score_stream
from tidecast.streaming.score import score_stream

# ---------------------------------------------------------------------------
# shared inputs
# ---------------------------------------------------------------------------

SEQ_COLS = ["close", "volume"]
SEQ = dict(window=20, stride=5, telescope=2)


def _seq_input(spark, d):
    b = fx.bars_multi(spark, d).select("symbol", "date", "close", F.col("volume").cast("double").alias("volume"))
    return b


def prepared_1f(spark, d):
    """bars_multi ⟕ m_monthly, filled, complete rows, index, split 0.8 (the flagship's input)."""
    bars = fx.bars_multi(spark, d).select("symbol", "date", "open", "close")
    return prepare(bars, fx.series_wide(spark, d), ["m_monthly"], by="symbol", ratio=0.8)


FEATURES_1F = ["open"]


def _materialized(df):
    """``df`` written to the shared checkpoint folder and read back."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _coefs_1f(spark, d):
    # written once: the fit, the scoring and whatever comes after read this one table
    p = _materialized(prepared_1f(spark, d))
    return p, models.fit_grouped_linear(p.where("is_train"), FEATURES_1F, "close", "symbol")


def _preds_1f(spark, d):
    p, c = _coefs_1f(spark, d)
    return p, models.predict_grouped_linear(c, p.where("NOT is_train"), FEATURES_1F, "symbol")


def model_data(spark, d):
    """All-feature model table: bars ⟕ 3 series, filled by symbol, calendar, index, split 0.8.

    Features are every numeric column but the label, index included, as in the
    reference pipeline; the symbol is the key, not a feature.
    """
    b = fx.bars_multi(spark, d)
    j = enrich(b, fx.series_wide(spark, d), on="date", by="symbol")
    j = forward_fill(j, fx.SERIES_COLS, "date", by="symbol")
    j = drop_missing(j).withColumn("volume", F.col("volume").cast("double"))
    j = cal.with_calendar(j, "date")
    j = row_index(j, "date", by="symbol")
    return ordered_split(j, 0.8, "date", by="symbol")


MODEL_FEATURES = ["open", "high", "low", "volume", *fx.SERIES_COLS, "year", "month", "day", "fulldate", "idx"]


def _train_test(spark, d):
    m = _materialized(model_data(spark, d))
    return m.where("is_train"), m.where("NOT is_train")


_PREP_1F_CTES = [
    ("j", "SELECT b.symbol, b.date, b.open, b.close, w.m_monthly FROM bars_multi b "
          "LEFT JOIN series_wide w ON b.date = w.date"),
    ("f", f"SELECT symbol, date, open, close, {_ff_sql('m_monthly', 'symbol')} AS m_monthly FROM j"),
    ("dd", "SELECT * FROM f WHERE open IS NOT NULL AND NOT isnan(open) AND close IS NOT NULL AND NOT isnan(close) "
           "AND m_monthly IS NOT NULL AND NOT isnan(m_monthly)"),
    ("s", f"SELECT *, {_IDX} AS idx, ({_IDX}) < floor(count(*) OVER (PARTITION BY symbol) * 0.8) AS is_train "
          "FROM dd"),
    ("c", "SELECT symbol, count(*) AS n, regr_intercept(close, open) AS a, regr_slope(close, open) AS b FROM s "
          "WHERE is_train GROUP BY symbol"),
    ("p", "SELECT s.*, c.a + c.b * s.open AS prediction FROM s JOIN c ON s.symbol = c.symbol WHERE NOT s.is_train"),
]


def _sql_1f(body: str, extra=()) -> str:
    return with_views(body, "bars_multi", "series_wide", extra=[*_PREP_1F_CTES, *extra])


_PRED_SQL = _sql_1f("SELECT symbol, idx, date, close, round(prediction, 4) AS prediction FROM p")


def _pred_cols(df):
    return df.select("symbol", "idx", "date", "close", F.round("prediction", 4).alias("prediction"))


# ---------------------------------------------------------------------------
# 2.8 sequences
# ---------------------------------------------------------------------------

_W, _S, _T = SEQ["window"], SEQ["stride"], SEQ["telescope"]
_SEQ_SQL = with_views(f"""
SELECT st.symbol, st.s AS start, CASE WHEN ro.p - st.s < {_W} THEN 'input' ELSE 'label' END AS part,
       CASE WHEN ro.p - st.s < {_W} THEN ro.p - st.s ELSE ro.p - st.s - {_W} END AS step, ro.close, ro.volume
FROM starts st JOIN rws ro ON st.symbol = ro.symbol AND ro.p >= st.s AND ro.p < st.s + {_W + _T}""",
    "bars_multi", extra=[
        ("r", f"SELECT symbol, close, CAST(volume AS DOUBLE) AS volume, {_IDX} AS idx, "
              "count(*) OVER (PARTITION BY symbol) AS n FROM bars_multi"),
        ("g", f"SELECT symbol, any_value(n) AS n, ({_W} - any_value(n) % {_W}) % {_W} AS pad FROM r GROUP BY symbol"),
        ("rws", "SELECT r.symbol, r.idx + g.pad AS p, r.close, r.volume FROM r JOIN g ON r.symbol = g.symbol "
                "UNION ALL SELECT symbol, unnest(range(0, pad)) AS p, 0.0 AS close, 0.0 AS volume FROM g"),
        ("starts", f"SELECT symbol, unnest(range(0, n + pad - {_W + _T}, {_S})) AS s FROM g"),
    ])


@register("build_sequences", _SEQ_SQL)
def q_build_sequences(spark, d):
    seqs = sequences.build_sequences(_seq_input(spark, d), SEQ_COLS, "date", by="symbol", **SEQ)
    return sequences.sequences_long(seqs, SEQ_COLS, by="symbol")


@register("single_step_sequences", with_views(
    "SELECT symbol, date, CAST(0 AS BIGINT) AS step, close, CAST(volume AS DOUBLE) AS volume FROM bars_multi",
    "bars_multi"))
def q_single_step_sequences(spark, d):
    s = sequences.single_step_sequences(_seq_input(spark, d), SEQ_COLS)
    e = s.select("symbol", "date", F.posexplode("seq").alias("step", "_v"))
    return e.select("symbol", "date", F.col("step").cast("long").alias("step"),
                    *[F.col("_v")[i].alias(c) for i, c in enumerate(SEQ_COLS)])


_RW, _RT = 5, 2


@register("rolling_frame_sequences", with_views(f"""
SELECT a.symbol, a.date, CASE WHEN r.idx <= a.idx THEN 'input' ELSE 'label' END AS part,
       CASE WHEN r.idx <= a.idx THEN r.idx - a.idx + {_RW - 1} ELSE r.idx - a.idx - 1 END AS step, r.close, r.volume
FROM r a JOIN r ON a.symbol = r.symbol AND r.idx BETWEEN a.idx - {_RW - 1} AND a.idx + {_RT}
WHERE a.idx >= {_RW - 1} AND a.idx + {_RT} < a.n""", "bars_multi", extra=[
    ("r", f"SELECT symbol, date, close, CAST(volume AS DOUBLE) AS volume, {_IDX} AS idx, "
          "count(*) OVER (PARTITION BY symbol) AS n FROM bars_multi")]))
def q_rolling_frame_sequences(spark, d):
    s = sequences.rolling_frame_sequences(_seq_input(spark, d), SEQ_COLS, "date", by="symbol",
                                          window=_RW, telescope=_RT, bucket_rows=256, chunk="year")
    return sequences.sequences_long(s.select("symbol", "date", "inputs", "labels"), SEQ_COLS,
                                    by="symbol", anchor="date")


# ---------------------------------------------------------------------------
# 2.10 feature preparation
# ---------------------------------------------------------------------------

@register("assemble", with_views(
    "SELECT date, CAST(i AS BIGINT) AS i, v AS value FROM (SELECT date, "
    "unnest(range(0, 4)) AS i, unnest([open, high, low, close]) AS v FROM bars)", "bars"))
def q_assemble(spark, d):
    a = models.assemble(fx.bars(spark, d), ["open", "high", "low", "close"])
    a = a.select("date", F.posexplode(vector_to_array("features")).alias("i", "value"))
    return a.withColumn("i", F.col("i").cast("long"))


# ---------------------------------------------------------------------------
# 2.11 models and evaluation
# ---------------------------------------------------------------------------

@register("linear_regression", _sql_1f(
    "SELECT symbol, n, round(a, 4) AS intercept, round(b, 8) AS coef_open FROM c"))
def q_linear_regression(spark, d):
    _p, c = _coefs_1f(spark, d)
    return c.select("symbol", "n", F.round("intercept", 4).alias("intercept"),
                    F.round("coef_open", 8).alias("coef_open"))


@register("linear_regression_refit", _sql_1f("SELECT symbol, n, round(a, 4) AS intercept, round(b, 8) AS coef_open FROM c"))
def q_linear_regression_refit(spark, d):
    """The same coefficients from stored moments by year: the early years first, the later ones as they come."""
    p = _materialized(prepared_1f(spark, d).where("is_train").withColumn("year", F.year("date")))
    path = shared_path(spark, "moments")
    for part in ("year < 1995", "year >= 1995"):
        models.store_moments(p.where(part), path, FEATURES_1F, "close", "symbol", "year")
    c = models.refit_linear(spark, path, FEATURES_1F, "symbol")
    return c.select("symbol", "n", F.round("intercept", 4).alias("intercept"), F.round("coef_open", 8).alias("coef_open"))


@register("predict", _PRED_SQL)
def q_predict(spark, d):
    _p, preds = _preds_1f(spark, d)
    return _pred_cols(preds)


@register("rmse", _sql_1f("SELECT symbol, round(sqrt(avg(power(close - prediction, 2))), 3) AS rmse FROM p "
                          "GROUP BY symbol"))
def q_rmse(spark, d):
    _p, preds = _preds_1f(spark, d)
    r = models.evaluate(preds, "rmse", "close", by="symbol")
    return r.select("symbol", F.round("rmse", 3).alias("rmse"))


@register("r2", _sql_1f("SELECT symbol, round(1 - sum(power(close - prediction, 2)) / "
                        "(var_pop(close) * count(close)), 6) AS r2 FROM p GROUP BY symbol"))
def q_r2(spark, d):
    _p, preds = _preds_1f(spark, d)
    r = models.evaluate(preds, "r2", "close", by="symbol")
    return r.select("symbol", F.round("r2", 6).alias("r2"))


def _fit_predict(spark, d, kind, **params):
    train, test = _train_test(spark, d)
    m = models.fit(train, kind, MODEL_FEATURES, "close", **params)
    return m, models.predict(m, test).select("symbol", "idx", "date", "close", "prediction")


@register("random_forest")
def q_random_forest(spark, d):
    return _fit_predict(spark, d, "rf", numTrees=3)[1]


@register("gbt")
def q_gbt(spark, d):
    return _fit_predict(spark, d, "gbt")[1]


@register("assembled_estimator")
def q_assembled_estimator(spark, d):
    return _fit_predict(spark, d, "lr")[1]


@register("compare_models")
def q_compare_models(spark, d):
    train, test = _train_test(spark, d)
    _preds, metric = models.compare_models(train, test, ["lr", "rf", "gbt"], MODEL_FEATURES, "close",
                                           metric=["rmse", "r2"], params={"rf": {"numTrees": 3}})
    return metric


@register("model_choice")
def q_model_choice(spark, d):
    _m, preds = _fit_predict(spark, d, "rf", numTrees=10)
    return models.evaluate(preds, "rmse", "close", by="symbol")


@register("grid_search_cv")
def q_grid_search_cv(spark, d):
    """The reference's nine settings on expanding blocks, each fold scored from one forest of 150 trees of depth 15: 12
    fits of 25 trees instead of 18 of up to 150."""
    train, _test = _train_test(spark, d)
    _best, table = trees.tune_forest(train, MODEL_FEATURES, "close", grid=models.REFERENCE_RF_GRID, folds=3, refit=False, maxMemoryInMB=64)
    return table


@register("actual_vs_predicted", _sql_1f(
    "SELECT s.symbol, s.idx, s.date, s.close, round(p.prediction, 4) AS prediction FROM s "
    "LEFT JOIN p ON s.symbol = p.symbol AND s.idx = p.idx"))
def q_actual_vs_predicted(spark, d):
    p, preds = _preds_1f(spark, d)
    t = forecast.forecast_table(p, preds, by="symbol")
    return t.withColumn("prediction", F.round("prediction", 4))


def held_out_forecast(prepared, cols, label: str, window: int, stride: int, telescope: int, reg: float = 0.1, by="symbol"):
    """Multi-step forecast on a held-out part of an indexed and split table: scale on train, window, a ridge regression of
    every step ahead, all solved together.

    Windows whose labels end in the train part are fitted; those whose labels begin in the test part are scored, and no
    other. Returns (horizon, n, rmse_scaled, rmse): on the scaled label and in its own units."""
    scaled = minmax(prepared, cols, by=by)
    args, at = (window, stride, telescope), cols.index(label)
    blocks = ridge.window_blocks(scaled, cols, *args, by=by)
    model = ridge.fit_window_ridge(blocks, *args, label=at, reg=reg)
    preds = ridge.predict_windows(model, blocks, *args, at, by=by)
    preds = preds.withColumns({"_y": F.col("label"), "_p": F.col("prediction")})
    preds = inverse_minmax(preds, ["_y", "_p"], prepared, like=label, by=by)
    rmse = lambda a, b: F.sqrt(F.avg(F.pow(F.col(a) - F.col(b), 2)))
    return preds.groupBy("horizon").agg(F.count("*").alias("n"), rmse("label", "prediction").alias("rmse_scaled"), rmse("_y", "_p").alias("rmse"))


@register("windowed_forecast")
def q_windowed_forecast(spark, d):
    """Windows of 400 rows of all columns, every 25, 20 steps ahead; RMSE by step on the held-out fifth."""
    return held_out_forecast(_materialized(model_data(spark, d)), ["close", *MODEL_FEATURES], "close", 400, 25, 20)


@register("windowed_forecast_last_value", with_views(f"""
SELECT h.h AS horizon, count(*) AS n, round(sqrt(avg(power(y.close - x.close, 2))), 3) AS rmse
FROM starts st JOIN r x ON st.symbol = x.symbol AND x.idx = st.first - 1
JOIN (SELECT unnest(range(1, 3)) AS h) h ON true JOIN r y ON y.symbol = x.symbol AND y.idx = st.first + h.h - 1
GROUP BY 1""", "bars_multi", extra=[
    ("r", f"SELECT symbol, close, {_IDX} AS idx, count(*) OVER (PARTITION BY symbol) AS n FROM bars_multi"),
    ("g", "SELECT symbol, any_value(n) AS n, (20 - any_value(n) % 20) % 20 AS pad FROM r GROUP BY symbol"),
    ("starts", "SELECT * FROM (SELECT symbol, n, s + 20 - pad AS first FROM (SELECT symbol, n, pad, "
               "unnest(range(0, n + pad - 22, 5)) AS s FROM g)) WHERE first >= floor(n * 0.8)")]))
def q_windowed_forecast_last_value(spark, d):
    """The windows, the held-out part and the error by step, with the last value as the forecast."""
    b = ordered_split(row_index(_seq_input(spark, d), "date", by="symbol"), 0.8, "date", by="symbol")
    seqs = sequences.build_sequences(b, ["close"], "date", by="symbol", window=20, stride=5, telescope=2, idx="idx")
    ends = b.groupBy("symbol").agg(F.count("*").alias("_n"), F.count_if("is_train").alias("_cut"))
    first = F.col("start") + 20 - F.pmod(F.lit(20) - F.pmod("_n", F.lit(20)), F.lit(20))
    held = join_on_keys(seqs, ends, "symbol").where(first >= F.col("_cut"))
    steps = held.select(F.element_at("inputs", -1)[0].alias("x"), F.posexplode("labels").alias("h", "y"))
    return steps.groupBy((F.col("h") + 1).cast("long").alias("horizon")).agg(
        F.count("*").alias("n"), F.round(F.sqrt(F.avg(F.pow(F.col("y")[0] - F.col("x"), 2))), 3).alias("rmse"))


# MLlib with a line of its own for every symbol, in one fit: least squares by symbol, which SQL can state


def _symbol_lines(spark, d):
    """(prepared rows with a row id, one MLlib model of an intercept and a slope for each symbol). The symbol is read from
    the row id, which explanations keep with the points that they make."""
    p = _materialized(_with_row_id(prepared_1f(spark, d)))
    stages = [SQLTransformer(statement="SELECT *, substring_index(row_id, ':', 1) AS _symbol FROM __THIS__"),
              StringIndexer(inputCol="_symbol", outputCol="_i", stringOrderType="alphabetAsc"),
              OneHotEncoder(inputCol="_i", outputCol="_own", dropLast=False), VectorAssembler(inputCols=FEATURES_1F, outputCol="_x"),
              Interaction(inputCols=["_own", "_x"], outputCol="_slopes"), VectorAssembler(inputCols=["_own", "_slopes"], outputCol="features"),
              models.model_choice("lr", featuresCol="features", labelCol="close", fitIntercept=False)]
    return p, Pipeline(stages=stages).fit(p.where("is_train"))


@register("mllib_linear_regression", _sql_1f("SELECT symbol, round(a, 4) AS intercept, round(b, 8) AS coef_open FROM c"))
def q_mllib_linear_regression(spark, d):
    _p, m = _symbol_lines(spark, d)
    symbols, w = m.stages[1].labels, m.stages[-1].coefficients.toArray()
    # one row per symbol, as many as the model has lines
    table = spark.createDataFrame([(s, float(w[i]), float(w[len(symbols) + i])) for i, s in enumerate(symbols)], "symbol string, intercept double, coef_open double")
    return table.select("symbol", F.round("intercept", 4).alias("intercept"), F.round("coef_open", 8).alias("coef_open"))


@register("mllib_predict", _PRED_SQL)
def q_mllib_predict(spark, d):
    p, m = _symbol_lines(spark, d)
    return _pred_cols(models.predict(m, p.where("NOT is_train")))


@register("mllib_metrics", _sql_1f(
    "SELECT symbol, round(sqrt(avg(power(close - prediction, 2))), 3) AS rmse, round(1 - sum(power(close - prediction, 2)) / "
    "(var_pop(close) * count(close)), 6) AS r2 FROM p GROUP BY symbol"))
def q_mllib_metrics(spark, d):
    p, m = _symbol_lines(spark, d)
    r = models.evaluate(models.predict(m, p.where("NOT is_train")), ["rmse", "r2"], by="symbol")
    return r.select("symbol", F.round("rmse", 3).alias("rmse"), F.round("r2", 6).alias("r2"))


@register("mllib_saved_model", _PRED_SQL)
def q_mllib_saved_model(spark, d):
    p, m = _symbol_lines(spark, d)
    path = save_model(m, os.path.join(shared_path(spark, "model"), "lr"))
    return _pred_cols(models.predict(load_model(path), p.where("NOT is_train")))


@register("lime_linear", _sql_1f(
    "SELECT p.symbol, min(p.idx) AS idx, 'open' AS feature, round(any_value(c.b), 6) AS weight FROM p JOIN c ON p.symbol = c.symbol GROUP BY p.symbol"))
def q_lime_linear(spark, d):
    """The first test row of each symbol: its local surrogate is its symbol's slope."""
    p, m = _symbol_lines(spark, d)
    rows = first_row(p.where("NOT is_train"), "symbol", "idx")
    w = explain.lime(m, p.where("is_train"), rows, FEATURES_1F, row_id="row_id", top_k=10)
    return w.select(*_row_key(), "feature", F.round("weight", 6).alias("weight"))


@register("shap_sampled_linear", _sql_1f(
    "SELECT p.symbol, p.idx, 'open' AS feature, round(c.b * (p.open - f.mu), 3) AS phi FROM p JOIN c ON p.symbol = c.symbol, "
    "(SELECT avg(open) AS mu FROM s WHERE is_train) f"))
def q_shap_sampled_linear(spark, d):
    """With a background of one row, sampled Shapley values of each symbol's line are exact."""
    p, m = _symbol_lines(spark, d)
    background = p.where("is_train").agg(F.avg("open").alias("open"))
    phi = explain.shap_sampled(m, background, p.where("NOT is_train"), FEATURES_1F, row_id="row_id", n_perm=4)
    return phi.select(*_row_key(), "feature", F.round("phi", 3).alias("phi"))


# The same over all symbols: one pooled fit, whose least squares SQL states too

_POOLED = [
    ("cp", "SELECT count(*) AS n, regr_intercept(close, open) AS a, regr_slope(close, open) AS b, avg(open) AS mu FROM s "
           "WHERE is_train"),
    ("pp", "SELECT s.*, cp.a + cp.b * s.open AS prediction, cp.b AS slope, cp.mu FROM s, cp WHERE NOT s.is_train"),
]
_POOLED_PRED_SQL = _sql_1f("SELECT symbol, idx, date, close, round(prediction, 4) AS prediction FROM pp", _POOLED)


def _pooled(spark, d):
    p = _materialized(prepared_1f(spark, d))
    return p, models.fit(p.where("is_train"), "lr", FEATURES_1F, "close")


def _row_key(row_id: str = "row_id"):
    """The symbol and the index that ``_with_row_id`` has joined."""
    idx = F.substring_index(row_id, ":", -1)
    return F.col(row_id).substr(F.lit(1), F.length(row_id) - F.length(idx) - 1).alias("symbol"), idx.cast("long").alias("idx")


@register("mllib_linear_regression_pooled", _sql_1f(
    "SELECT n, round(a, 4) AS intercept, round(b, 8) AS coef_open FROM cp", _POOLED))
def q_mllib_linear_regression_pooled(spark, d):
    p, m = _pooled(spark, d)
    c = models.linear_coefficients(m, FEATURES_1F)
    return p.where("is_train").agg(F.count("*").alias("n")).select(
        "n", F.round(F.lit(c["intercept"]), 4).alias("intercept"), F.round(F.lit(c["coef_open"]), 8).alias("coef_open"))


@register("mllib_predict_pooled", _POOLED_PRED_SQL)
def q_mllib_predict_pooled(spark, d):
    p, m = _pooled(spark, d)
    return _pred_cols(models.predict(m, p.where("NOT is_train")))


@register("mllib_metrics_pooled", _sql_1f(
    "SELECT symbol, round(sqrt(avg(power(close - prediction, 2))), 3) AS rmse, round(1 - sum(power(close - prediction, 2)) / "
    "(var_pop(close) * count(close)), 6) AS r2 FROM pp GROUP BY symbol", _POOLED))
def q_mllib_metrics_pooled(spark, d):
    p, m = _pooled(spark, d)
    r = models.evaluate(models.predict(m, p.where("NOT is_train")), ["rmse", "r2"], by="symbol")
    return r.select("symbol", F.round("rmse", 3).alias("rmse"), F.round("r2", 6).alias("r2"))


@register("mllib_saved_model_pooled", _POOLED_PRED_SQL)
def q_mllib_saved_model_pooled(spark, d):
    p, m = _pooled(spark, d)
    path = save_model(m, os.path.join(shared_path(spark, "model"), "lr"))
    return _pred_cols(models.predict(load_model(path), p.where("NOT is_train")))


@register("lime_linear_pooled", _sql_1f(
    "SELECT symbol, min(idx) AS idx, 'open' AS feature, round(any_value(slope), 6) AS weight FROM pp GROUP BY symbol", _POOLED))
def q_lime_linear_pooled(spark, d):
    """The first test row of each symbol: a linear model's local surrogate is its slope."""
    p, m = _pooled(spark, d)
    w = explain.lime(m, p.where("is_train"), _explained_rows(p.where("NOT is_train")), FEATURES_1F, row_id="row_id", top_k=10)
    return w.select(*_row_key(), "feature", F.round("weight", 6).alias("weight"))


@register("shap_sampled_linear_pooled", _sql_1f(
    "SELECT symbol, idx, 'open' AS feature, round(slope * (open - mu), 3) AS phi FROM pp", _POOLED))
def q_shap_sampled_linear_pooled(spark, d):
    """Every test row against one background row, the mean of all train rows: exact for a linear model."""
    p, m = _pooled(spark, d)
    background = p.where("is_train").agg(F.avg("open").alias("open"))
    phi = explain.shap_sampled(m, background, _with_row_id(p.where("NOT is_train")), FEATURES_1F, row_id="row_id", n_perm=4)
    return phi.select(*_row_key(), "feature", F.round("phi", 3).alias("phi"))


@register("tree_checks", _sql_1f(
    "SELECT m.model, CAST(12 AS BIGINT) AS features, 1.0::DOUBLE AS total, n.n AS scored, n.n AS distinct_keys FROM "
    "(SELECT unnest(['gbt', 'rf']) AS model) m, (SELECT count(*) AS n FROM p_all) n",
    extra=[("j3", "SELECT b.*, w.m_monthly, w.m_weekly, w.m_daily FROM bars_multi b LEFT JOIN series_wide w ON b.date = w.date"),
           ("f3", "SELECT symbol, date, " + ", ".join(f"{_ff_sql(c, 'symbol')} AS {c}" for c in fx.SERIES_COLS) + " FROM j3"),
           ("d3", "SELECT * FROM f3 WHERE m_monthly IS NOT NULL AND m_weekly IS NOT NULL AND m_daily IS NOT NULL"),
           ("p_all", f"SELECT * FROM (SELECT *, ({_IDX}) < floor(count(*) OVER (PARTITION BY symbol) * 0.8) AS tr FROM d3) WHERE NOT tr")]))
def q_tree_checks(spark, d):
    """Forests and boosted trees: importances of all features that sum to one, one prediction for each test row."""
    train, test = _train_test(spark, d)
    out = None
    for kind, params in (("rf", {"numTrees": 3}), ("gbt", {"maxIter": 5})):
        m = models.fit(train, kind, MODEL_FEATURES, "close", **params)
        imp = explain.importances(spark, m, MODEL_FEATURES, kind).groupBy("model").agg(
            F.count("*").alias("features"), F.round(F.sum("importance"), 9).alias("total"))
        n = models.predict(m, test).where("prediction IS NOT NULL").agg(
            F.count("*").alias("scored"), F.count_distinct("symbol", "idx").alias("distinct_keys"))
        row = imp.withColumns({"scored": n.select("scored").scalar(), "distinct_keys": n.select("distinct_keys").scalar()})
        out = row if out is None else out.unionByName(row)
    return out


@register("search_checks", "SELECT CAST(2 AS BIGINT) AS settings, true AS best_is_least, CAST(4 AS BIGINT) AS fits")
def q_search_checks(spark, d):
    """A grid of two settings on three expanding folds: two rows, the refitted one has the least error."""
    train, _test = _train_test(spark, d)
    fits: list[str] = []
    best, table = models.tune(train, "rf", MODEL_FEATURES, "close", grid={"maxDepth": [2, 4]}, folds=3, parallelism=4, on_fit=fits.append)
    depth = best.stages[-1].getOrDefault("maxDepth")
    least = F.min_by("params", "rmse") == f"maxDepth={depth}"
    return table.agg(F.count("*").alias("settings"), least.alias("best_is_least"), F.lit(len(fits)).cast("long").alias("fits"))


@register("lag_features", with_views(
    "SELECT symbol, date, close, lag(close, 1) OVER w AS close_lag1, lag(close, 2) OVER w AS close_lag2, "
    "lag(close, 3) OVER w AS close_lag3 FROM bars_multi WINDOW w AS (PARTITION BY symbol ORDER BY date)", "bars_multi"))
def q_lag_features(spark, d):
    return lag_features(fx.bars_multi(spark, d).select("symbol", "date", "close"), "close", 3, "date", by="symbol")


@register("symbol_index", with_views(
    "SELECT symbol, date, dense_rank() OVER (ORDER BY symbol) - 1 AS symbol_idx FROM bars_multi", "bars_multi"))
def q_symbol_index(spark, d):
    return symbol_index(fx.bars_multi(spark, d).select("symbol", "date"))


@register("pooled_model")
def q_pooled_model(spark, d):
    """One forest over all symbols, which it can tell apart by their index."""
    m = symbol_index(_materialized(model_data(spark, d)))
    features = [*MODEL_FEATURES, "symbol_idx"]
    fitted = models.fit(m.where("is_train"), "rf", features, "close", numTrees=3)
    return models.evaluate(models.predict(fitted, m.where("NOT is_train")), "rmse", "close", by="symbol")


# ---------------------------------------------------------------------------
# 2.12 explanations
# ---------------------------------------------------------------------------

def _with_row_id(rows):
    return rows.withColumn("row_id", F.concat_ws(":", "symbol", F.col("idx").cast("string")))


def _explained_rows(test):
    """The first test row of each symbol (the row the reference explains), with a row id."""
    return _with_row_id(first_row(test, "symbol", "idx"))


@register("feature_importance")
def q_feature_importance(spark, d):
    train, _test = _train_test(spark, d)
    rf = models.fit(train, "rf", MODEL_FEATURES, "close", numTrees=3)
    gbt = models.fit(train, "gbt", MODEL_FEATURES, "close")
    return explain.importances(spark, rf, MODEL_FEATURES, "rf").unionByName(explain.importances(spark, gbt, MODEL_FEATURES, "gbt"))


@register("lime")
def q_lime(spark, d):
    train, test = _train_test(spark, d)
    m = models.fit(train, "lr", MODEL_FEATURES, "close")
    rows = _explained_rows(test)
    return explain.lime(m, train, rows, MODEL_FEATURES, row_id="row_id", n_samples=5000, top_k=10)


@register("lime_quartile")
def q_lime_quartile(spark, d):
    """The tabular default for each model: quartile bins, 5000 samples, top 10 features, ridge."""
    train, test = _train_test(spark, d)
    fitted = {kind: models.fit(train, kind, MODEL_FEATURES, "close", **params) for kind, params in (("lr", {}), ("rf", {"numTrees": 3}), ("gbt", {}))}
    out = explain.lime_quartile_models(fitted, train, _explained_rows(test), MODEL_FEATURES, row_id="row_id")
    return out.select("row_id", "feature", "condition", "weight", "model")


_SHAP_SQL_BODY = ("SELECT t.symbol, t.idx, 'open' AS feature, round(c.b * (t.open - m.mu), 4) AS phi "
                  "FROM s t JOIN c ON t.symbol = c.symbol JOIN "
                  "(SELECT symbol, avg(open) AS mu FROM s WHERE is_train GROUP BY symbol) m ON t.symbol = m.symbol "
                  "WHERE NOT t.is_train")


def _shap_1f(spark, d):
    p, c = _coefs_1f(spark, d)
    return explain.shap_linear(c, p.where("is_train"), p.where("NOT is_train"), FEATURES_1F, "idx", by="symbol")


@register("shap_linear", _sql_1f(_SHAP_SQL_BODY))
def q_shap_linear(spark, d):
    return _shap_1f(spark, d).withColumn("phi", F.round("phi", 4))


@register("shap_sampled")
def q_shap_sampled(spark, d):
    train, test = _train_test(spark, d)
    m = models.fit(train, "rf", MODEL_FEATURES, "close", numTrees=3)
    # every test row is explained, as the tree explainer runs over the whole test part
    return explain.shap_sampled(m, train, _with_row_id(test), MODEL_FEATURES, row_id="row_id")


@register("shap_summary", _sql_1f(
    "SELECT symbol, feature, round(avg(abs(phi)), 4) AS mean_abs_phi FROM (" +
    _SHAP_SQL_BODY.replace("round(c.b * (t.open - m.mu), 4)", "c.b * (t.open - m.mu)") + ") GROUP BY 1, 2"))
def q_shap_summary(spark, d):
    s = explain.shap_summary(_shap_1f(spark, d), by="symbol")
    return s.withColumn("mean_abs_phi", F.round("mean_abs_phi", 4))


# ---------------------------------------------------------------------------
# 2.13 future scoring, streaming, SQL surface, sinks
# ---------------------------------------------------------------------------

@register("future_frame", with_views(
    "SELECT symbol, CAST(step AS BIGINT) AS step, CAST(d + INTERVAL (step) DAY AS DATE) AS date, "
    "CAST(year(d + INTERVAL (step) DAY) AS INTEGER) AS year, CAST(month(d + INTERVAL (step) DAY) AS INTEGER) AS month, "
    "CAST(day(d + INTERVAL (step) DAY) AS INTEGER) AS day, CAST(strftime(d + INTERVAL (step) DAY, '%Y%m%d') AS INTEGER) "
    "AS fulldate FROM (SELECT symbol, max(date) AS d FROM bars_multi GROUP BY symbol), range(0, 11) t(step)",
    "bars_multi"))
def q_future_frame(spark, d):
    return forecast.future_frame(fx.bars_multi(spark, d), 10, by="symbol")


@register("predict_future", _sql_1f(
    "SELECT l.symbol, CAST(t.step AS BIGINT) AS step, CAST(l.date + INTERVAL (t.step) DAY AS DATE) AS date, "
    "round(c.a + c.b * l.open, 4) AS prediction FROM "
    "(SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1) l "
    "JOIN c ON l.symbol = c.symbol, range(0, 11) t(step)"))
def q_predict_future(spark, d):
    p, c = _coefs_1f(spark, d)
    fut = forecast.carry_forward(p, 10, by="symbol")
    out = models.predict_grouped_linear(c, fut, FEATURES_1F, "symbol")
    return out.select("symbol", "step", "date", F.round("prediction", 4).alias("prediction"))


@register("score_new_bars", _PRED_SQL)
def q_score_new_bars(spark, d):
    """Newly arrived bars (the test part, landed as files) scored by a stream with the fitted coefficients."""
    p, c = _coefs_1f(spark, d)
    landing = shared_path(spark, "landing")
    arrived = p.where("NOT is_train").select("symbol", "idx", "date", "open", "close")
    arrived.write.mode("overwrite").parquet(landing)
    # the stream reads a stored table of coefficients: no batch fits the model again
    out_dir, _q = score_stream(spark, landing, arrived.schema, FEATURES_1F, coefs=_materialized(c), by="symbol",
                               keep=["symbol", "idx", "date", "close"])
    return _pred_cols(spark.read.parquet(out_dir))


@register("stream_prepare", _sql_1f(
    "SELECT s.symbol, s.idx, s.date, s.close, s.m_monthly, round(c.a + c.b * s.open, 4) AS prediction FROM s JOIN c ON s.symbol = c.symbol"))
def q_stream_prepare(spark, d):
    """Raw bars arrive in four deliveries; the stream joins, fills, drops, indexes and scores them, as the batch does."""
    _p, c = _coefs_1f(spark, d)
    c, series = _materialized(c), _materialized(fx.series_wide(spark, d).select("date", "m_monthly"))
    bars = _materialized(fx.bars_multi(spark, d).select("symbol", "date", "open", "close"))
    cuts = bars.agg(F.percentile_approx(F.unix_date("date"), [0.25, 0.5, 0.75]).alias("q")).first()["q"] or [0, 0, 0]
    part = F.size(F.filter(F.array(*[F.lit(x) for x in cuts]), lambda e: e < F.unix_date("date")))
    landing, sink = shared_path(spark, "raw-bars"), os.path.join(shared_path(spark, "prepared"), "data")
    for i in range(4):
        bars.where(part == i).write.mode("append").parquet(landing)
        prepare_and_score_stream(spark, landing, bars.schema, series, ["m_monthly"], c, FEATURES_1F, sink_dir=sink)
    return spark.read.parquet(sink).where("NOT late").select("symbol", "idx", "date", "close", "m_monthly", F.round("prediction", 4).alias("prediction"))


@register("sink_predictions", _PRED_SQL)
def q_sink_predictions(spark, d):
    _p, preds = _preds_1f(spark, d)
    path = write_predictions(preds.select("symbol", "idx", "date", "close", "prediction"),
                             shared_path(spark, "predictions"), by="symbol")
    return _pred_cols(spark.read.parquet(path))


@register("sink_model")
def q_sink_model(spark, d):
    train, test = _train_test(spark, d)
    m = models.fit(train, "lr", MODEL_FEATURES, "close")
    path = save_model(m, os.path.join(shared_path(spark, "model"), "lr"))
    return models.predict(load_model(path), test).select("symbol", "idx", "prediction")


@register("sql_view", with_views(
    "SELECT count(*) AS n, round(min(close), 4) AS min_close, round(max(close), 4) AS max_close "
    "FROM joined WHERE date >= DATE '1996-01-01' AND close > 1000.0", "joined"))
def q_sql_view(spark, d):
    return sql_view(fx.joined(spark, d), "dataset_view",
                    "SELECT count(*) AS n, round(min(close), 4) AS min_close, round(max(close), 4) AS max_close "
                    "FROM dataset_view WHERE date >= :start AND close > :lo",
                    {"start": datetime.date(1996, 1, 1), "lo": 1000.0})
