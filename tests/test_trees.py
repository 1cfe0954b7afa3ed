"""Exact Shapley values of trees, node tables, and the search by prefixes of one forest."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.operators import models, trees

FEATURES = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def data(spark):
    df = spark.range(600).select("id", F.pmod("id", F.lit(5)).cast("double").alias("a"), *[
        ((F.xxhash64("id", F.lit(s)) % 1000) / 1000.0).alias(c) for s, c in enumerate("bcde")])
    return df.withColumn("close", F.col("a") * F.col("b") + F.sin(F.col("c") * 5) + F.when(F.col("d") > 0.2, F.col("e")).otherwise(0)).checkpoint()


def value(tree, x, known, at=0):
    """What a tree says of x if only the features ``known`` are: unknown splits follow both branches by cover."""
    r = tree.loc[at]
    if r.left < 0:
        return r.value
    if int(r.feature) in known:
        return value(tree, x, known, int(r.left) if x[int(r.feature)] <= r.threshold else int(r.right))
    return sum(value(tree, x, known, int(c)) * tree.loc[int(c)].cover for c in (r.left, r.right)) / r.cover


def enumerated(flat, x, k):
    game = {s: sum(float(t["weight"][0]) * value(t, x, set(s)) for t in flat) for n in range(k + 1) for s in itertools.combinations(range(k), n)}
    out = []
    for j in range(k):
        rest = [i for i in range(k) if i != j]
        out.append(sum(math.factorial(n) * math.factorial(k - 1 - n) / math.factorial(k) * (game[tuple(sorted((*s, j)))] - game[s])
                       for n in range(k) for s in itertools.combinations(rest, n)))
    return out


@pytest.mark.parametrize("kind,params", [("rf", {"numTrees": 3, "maxDepth": 5}), ("gbt", {"maxIter": 4, "maxDepth": 4}), ("rf", {"numTrees": 1, "maxDepth": 0})])
def test_shap_tree_equals_all_subsets_and_sums_to_the_prediction(data, kind, params):
    m = models.fit(data, kind, FEATURES, "close", **params)
    flat, base = trees._flat(m), trees.expected_value(m)
    rows = data.limit(12)
    phi = {}
    for r in trees.shap_tree(m, rows, FEATURES, row_id="id").collect():
        phi.setdefault(r.id, {})[r.feature] = r.phi
    for r in models.predict(m, rows).collect():
        got = [phi[r.id][f] for f in FEATURES]
        assert np.allclose(got, enumerated(flat, [r[f] for f in FEATURES], 5), atol=1e-9)
        assert abs(sum(got) - (r.prediction - base)) < 1e-9


def test_pieces_give_the_same_values(data):
    m = models.fit(data, "gbt", FEATURES, "close", maxIter=3)
    key = lambda d: {(r.id, r.feature): r.phi for r in d.collect()}
    whole = trees.shap_tree(m, data, FEATURES, row_id="id")
    assert "hashpartitioning" not in whole._jdf.queryExecution().executedPlan().toString()
    a, b = key(whole), key(trees.shap_tree(m, data, FEATURES, row_id="id", piece_bytes=700))
    assert a.keys() == b.keys() and len(a) == 3000 and max(abs(a[k] - b[k]) for k in a) < 1e-9


def test_expected_value_is_the_mean_of_a_tree_without_bootstrap(data):
    m = models.fit(data, "rf", FEATURES, "close", numTrees=2, bootstrap=False, featureSubsetStrategy="all")
    assert abs(trees.expected_value(m) - data.agg(F.avg("close")).first()[0]) < 1e-9


def test_row_id_must_not_be_a_feature_and_linear_models_raise(data):
    m = models.fit(data, "lr", FEATURES, "close")
    with pytest.raises(ValueError):
        trees.shap_tree(m, data, FEATURES, row_id="id")
    with pytest.raises(ValueError):
        trees.shap_tree(m, data, FEATURES, row_id="a")


def test_a_prefix_of_the_forest_cut_at_a_depth_predicts_as_its_nodes_say(data):
    """All trees at full depth are the model itself; cut trees equal a forest grown to that depth where no draw differs."""
    held = data.where("id % 3 = 0")
    whole = models.fit(data, "rf", FEATURES, "close", numTrees=6, maxDepth=6, bootstrap=False, featureSubsetStrategy="all")
    for piece_bytes in (1 << 25, 3000):
        got = {(r.numTrees, r.maxDepth): r.sse for r in trees.score_settings(whole, held, FEATURES, "close", [2, 6], [2, 4, 6], piece_bytes).collect()}
        for (n, d), sse in got.items():
            own = models.fit(data, "rf", FEATURES, "close", numTrees=n, maxDepth=d, bootstrap=False, featureSubsetStrategy="all")
            want = models.predict(own, held).agg(F.sum(F.pow(F.col("close") - F.col("prediction"), 2))).first()[0]
            assert abs(sse - want) < 1e-6 * max(1, want), (n, d)


def test_search_fits_once_a_fold_and_agrees_with_separate_forests(data):
    timed = data.withColumn("date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")))
    grid, fits = {"numTrees": [5, 20], "maxDepth": [2, 5]}, []
    best, table = trees.tune_forest(timed, FEATURES, grid=grid, folds=3, grow=8, on_fit=fits.append)
    assert sorted(fits) == [f"fold={f},trees={a}" for f in (1, 2) for a in ("0-7", "16-19", "8-15")]
    one = {r.params: r.rmse for r in table.collect()}
    _m, other = models.tune(timed, "rf", FEATURES, grid=grid, folds=3, parallelism=4)
    two = {r.params: r.rmse for r in other.collect()}
    assert one.keys() == two.keys()
    assert all(abs(one[k] - two[k]) < 0.15 * two[k] for k in one), (one, two)
    assert f"maxDepth={best.stages[-1].getOrDefault('maxDepth')},numTrees={best.stages[-1].getNumTrees}" == min(one, key=one.get)


def test_search_checks_its_arguments(data):
    with pytest.raises(ValueError):
        trees.tune_forest(data, FEATURES, grid={"numTrees": [2], "maxDepth": [2], "maxBins": [8]})
    with pytest.raises(ValueError):
        trees.tune_forest(data, FEATURES, grid={"numTrees": [2], "maxDepth": [2]}, fold="none")
    with pytest.raises(ValueError):
        trees.tune_forest(data, FEATURES, grid={"numTrees": [2], "maxDepth": [2]}, folds=1)
