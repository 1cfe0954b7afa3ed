"""Registered tree queries whose values SQL can state, and the exact explanations of trees.

A tree without bootstrap on a feature of five values ends in the groups' means; a tree of depth 2 on two features of two
values has four cells. From these SQL states predictions, errors, importances and Shapley values of MLlib's trees.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecast.operators import explain, models, trees
from tidecast.plans.catalog import _IDX, _ff_sql, register
from tidecast.plans.catalog_models import (
    MODEL_FEATURES, _materialized, _row_key, _sql_1f, _train_test, _with_row_id, fx, prepared_1f,
)

#: Every tree sees all rows and all features, so that what it learns is a function of the data alone.
PLAIN = {"bootstrap": False, "featureSubsetStrategy": "all"}
PARAMS = {"rf": {"numTrees": 3, **PLAIN}, "gbt": {}, "lr": {}}


def _grouped(spark, d):
    """The one-feature table with the weekday and two features of two values."""
    p = prepared_1f(spark, d).withColumns({
        "weekday": F.weekday("date").cast("double"), "early": (F.weekday("date") < 2).cast("double"), "half": (F.month("date") <= 6).cast("double")})
    p = _materialized(p)
    return p.where("is_train"), p.where("NOT is_train")


_GROUPED = [
    ("w", "SELECT *, CAST(isodow(date) - 1 AS DOUBLE) AS weekday, CAST(isodow(date) < 3 AS INTEGER)::DOUBLE AS early, "
          "CAST(month(date) <= 6 AS INTEGER)::DOUBLE AS half FROM s"),
    ("g", "SELECT weekday, avg(close) AS mean FROM w WHERE is_train GROUP BY 1"),
    ("t", "SELECT w.symbol, w.idx, w.date, w.close, w.weekday, w.early, w.half, g.mean FROM w JOIN g ON w.weekday = g.weekday WHERE NOT is_train"),
    ("ln", "SELECT regr_intercept(close, weekday) AS a, regr_slope(close, weekday) AS b, avg(close) AS mu FROM w WHERE is_train"),
    ("m", "SELECT 'rf' AS model, t.*, mean AS prediction FROM t UNION ALL SELECT 'gbt', t.*, mean FROM t "
          "UNION ALL SELECT 'lr', t.*, ln.a + ln.b * weekday FROM t, ln"),
]
_PREDICTED = _sql_1f("SELECT symbol, idx, date, close, round(mean, 4) AS prediction FROM t", _GROUPED)


def _predicted(spark, d, kind):
    train, test = _grouped(spark, d)
    m = models.fit(train, kind, ["weekday"], "close", **PARAMS[kind])
    return models.predict(m, test).select("symbol", "idx", "date", "close", F.round("prediction", 4).alias("prediction"))


@register("random_forest_groups", _PREDICTED)
def q_random_forest_groups(spark, d):
    """A forest on the weekday says the weekday's mean."""
    return _predicted(spark, d, "rf")


@register("gbt_groups", _PREDICTED)
def q_gbt_groups(spark, d):
    """So do boosted trees: nothing is left to learn after the first."""
    return _predicted(spark, d, "gbt")


@register("compare_models_groups", _sql_1f(
    "SELECT model, round(sqrt(avg(power(close - prediction, 2))), 3) AS rmse, round(1 - sum(power(close - prediction, 2)) / "
    "(var_pop(close) * count(close)), 6) AS r2 FROM m GROUP BY model", _GROUPED))
def q_compare_models_groups(spark, d):
    train, test = _grouped(spark, d)
    _preds, metric = models.compare_models(train, test, ["lr", "rf", "gbt"], ["weekday"], "close", metric=["rmse", "r2"], params=PARAMS)
    return metric.select("model", F.round("rmse", 3).alias("rmse"), F.round("r2", 6).alias("r2"))


@register("model_choice_groups", _sql_1f(
    "SELECT model, symbol, count(*) AS n, round(sqrt(avg(power(close - prediction, 2))), 3) AS rmse FROM m GROUP BY 1, 2", _GROUPED))
def q_model_choice_groups(spark, d):
    """Every model that can be chosen by name, fitted and scored by symbol."""
    train, test = _grouped(spark, d)
    out = None
    for name in sorted(models.MODELS):
        est = models.make_pipeline(name, ["weekday"], "close", **PARAMS[name])
        scored = models.predict(est.fit(train), test).select(F.lit(name).alias("model"), "symbol", "close", "prediction")
        out = scored if out is None else out.unionByName(scored)
    counts = out.groupBy("model", "symbol").agg(F.count("*").alias("n"))
    rmse = models.evaluate(out, "rmse", by=["model", "symbol"]).withColumn("rmse", F.round("rmse", 3))
    return counts.join(rmse, ["model", "symbol"])


# the squared error that is left when nothing, one feature, or both are known; the better feature is the root's
_CELLS = [*_GROUPED,
          ("c0", "SELECT early, half, count(*)::DOUBLE AS n, sum(close) AS s, sum(close * close) AS q FROM w WHERE is_train GROUP BY 1, 2"),
          ("left0", "SELECT sum(q) - sum(s) * sum(s) / sum(n) AS e FROM c0"),
          ("left1", "SELECT sum(q - s * s / n) AS e FROM (SELECT early, sum(n) AS n, sum(s) AS s, sum(q) AS q FROM c0 GROUP BY 1)"),
          ("left2", "SELECT sum(q - s * s / n) AS e FROM (SELECT half, sum(n) AS n, sum(s) AS s, sum(q) AS q FROM c0 GROUP BY 1)"),
          ("left3", "SELECT sum(q - s * s / n) AS e FROM c0"),
          ("r", "SELECT left0.e AS e0, left3.e AS e3, left1.e AS e1, left2.e AS e2, left1.e <= left2.e AS early_first FROM left0, left1, left2, left3")]


def _pair_model(train):
    return models.fit(train, "rf", ["early", "half"], "close", numTrees=1, maxDepth=2, **PLAIN)


@register("feature_importance_pair", _sql_1f(
    "SELECT 'rf' AS model, 'early' AS feature, round((CASE WHEN early_first THEN e0 - e1 ELSE e2 - e3 END) / (e0 - e3), 6) AS importance FROM r "
    "UNION ALL SELECT 'rf', 'half', round((CASE WHEN early_first THEN e1 - e3 ELSE e0 - e2 END) / (e0 - e3), 6) FROM r", _CELLS))
def q_feature_importance_pair(spark, d):
    train, _test = _grouped(spark, d)
    imp = explain.importances(spark, _pair_model(train), ["early", "half"], "rf")
    return imp.withColumn("importance", F.round("importance", 6))


@register("shap_tree_pair", _sql_1f("""
SELECT t.symbol, t.idx, f.feature, round(CASE WHEN (f.feature = 'early') = r.early_first
       THEN ((root.mean - al.mean) + (cell.mean - other.mean)) / 2 ELSE ((other.mean - al.mean) + (cell.mean - root.mean)) / 2 END, 4) AS phi
FROM t, r, al, (SELECT unnest(['early', 'half']) AS feature) f, cell, root, other
WHERE cell.early = t.early AND cell.half = t.half
  AND root.v = CASE WHEN r.early_first THEN t.early ELSE t.half END AND other.v = CASE WHEN r.early_first THEN t.half ELSE t.early END""", [
    *_CELLS, ("cell", "SELECT early, half, s / n AS mean FROM c0"), ("al", "SELECT sum(s) / sum(n) AS mean FROM c0"),
    ("o", "SELECT CASE WHEN early_first THEN early ELSE half END AS rv, CASE WHEN early_first THEN half ELSE early END AS ov, n, s FROM c0, r"),
    ("rootn", "SELECT rv, sum(n) AS n, sum(s) AS s FROM o GROUP BY 1"), ("root", "SELECT rv AS v, s / n AS mean FROM rootn"),
    # only the other feature known: both branches of the root, by their share of the rows
    ("other", "SELECT o.ov AS v, sum(o.s / o.n * rootn.n) / (SELECT sum(n) FROM c0) AS mean FROM o JOIN rootn ON o.rv = rootn.rv GROUP BY 1")]))
def q_shap_tree_pair(spark, d):
    """Exact Shapley values of a tree of two features, for every test row."""
    train, test = _grouped(spark, d)
    phi = trees.shap_tree(_pair_model(train), _with_row_id(test), ["early", "half"], row_id="row_id")
    return phi.select(*_row_key(), "feature", F.round("phi", 4).alias("phi"))


@register("shap_tree_groups", _sql_1f(
    "SELECT model.model, t.symbol, t.idx, 'weekday' AS feature, round(t.mean - ln.mu, 4) AS phi FROM t, ln, (SELECT unnest(['rf', 'gbt']) AS model) model",
    _GROUPED))
def q_shap_tree_groups(spark, d):
    """One feature has the whole difference from the mean, in forests and boosted trees."""
    train, test = _grouped(spark, d)
    out = None
    for kind in ("rf", "gbt"):
        m = models.fit(train, kind, ["weekday"], "close", **PARAMS[kind])
        phi = trees.shap_tree(m, _with_row_id(test), ["weekday"], row_id="row_id")
        phi = phi.select(F.lit(kind).alias("model"), *_row_key(), "feature", F.round("phi", 4).alias("phi"))
        out = phi if out is None else out.unionByName(phi)
    return out


def _explained(spark, d):
    """(model name, model, Shapley values, test rows) of a forest and of boosted trees over all features."""
    train, test = _train_test(spark, d)
    rows = _with_row_id(test)
    for kind, params in (("rf", {"numTrees": 3}), ("gbt", {})):
        m = models.fit(train, kind, MODEL_FEATURES, "close", **params)
        yield kind, m, trees.shap_tree(m, rows, MODEL_FEATURES, row_id="row_id"), rows


@register("shap_tree")
def q_shap_tree(spark, d):
    """Exact Shapley values of every test row, all features, for the forest and the boosted trees."""
    out = None
    for kind, _m, phi, _rows in _explained(spark, d):
        phi = phi.select(F.lit(kind).alias("model"), *_row_key(), "feature", "phi")
        out = phi if out is None else out.unionByName(phi)
    return out


@register("shap_tree_sums", _sql_1f(
    "SELECT m.model, t.symbol, t.idx, CAST(12 AS BIGINT) AS features, true AS sums FROM p_all t, (SELECT unnest(['rf', 'gbt']) AS model) m", [
        ("j3", "SELECT b.*, w.m_monthly, w.m_weekly, w.m_daily FROM bars_multi b LEFT JOIN series_wide w ON b.date = w.date"),
        ("f3", "SELECT symbol, date, " + ", ".join(f"{_ff_sql(c, 'symbol')} AS {c}" for c in fx.SERIES_COLS) + " FROM j3"),
        ("d3", "SELECT * FROM f3 WHERE m_monthly IS NOT NULL AND m_weekly IS NOT NULL AND m_daily IS NOT NULL"),
        ("p_all", f"SELECT * FROM (SELECT *, {_IDX} AS idx, ({_IDX}) < floor(count(*) OVER (PARTITION BY symbol) * 0.8) AS tr FROM d3) WHERE NOT tr")]))
def q_shap_tree_sums(spark, d):
    """Every test row's values sum to its prediction less the model's mean."""
    out = None
    for kind, m, phi, rows in _explained(spark, d):
        total = phi.groupBy("row_id").agg(F.count("*").alias("features"), F.sum("phi").alias("total"))
        met = models.predict(m, rows).select("row_id", "prediction").join(total, "row_id")
        gap = F.abs(F.col("total") - (F.col("prediction") - F.lit(trees.expected_value(m))))
        part = met.select(F.lit(kind).alias("model"), *_row_key(), "features", (gap < 1e-9 * F.greatest(F.abs("prediction"), F.lit(1.0))).alias("sums"))
        out = part if out is None else out.unionByName(part)
    return out
