"""Node tables of tree models, exact Shapley values of trees (E4), and search by prefixes of one forest.

A fitted forest or boosted model is read as a table with one row per node. Scoring and explaining take it in pieces of a
bounded size, each sent to the workers once; rows are never collected, and a model of any size only means more pieces.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.session import shared_path

#: Bytes of tables that are sent to the workers at once.
PIECE_BYTES = 32 << 20
#: Rows times path elements that a worker handles at once.
CELLS = 1 << 22


def _stage(model):
    return model.stages[-1] if hasattr(model, "stages") else model


def node_table(model) -> DataFrame:
    """One row per node: tree, node, feature (-1: leaf), threshold, left, right, value, cover, gain and the tree's weight.

    ``value`` is the mean label of the train rows at the node (also of inner nodes), ``cover`` their weighted count.
    A value up to the threshold goes left. Written to the shared checkpoint folder in the model's own format and read back."""
    stage = _stage(model)
    if not hasattr(stage, "treeWeights"):
        raise ValueError("not a tree model")
    path = os.path.join(shared_path(_spark(), "trees"), "model")
    stage.write().save(path)
    kind = type(stage).__name__
    weights = [float(w) for w in stage.treeWeights]
    if "Forest" in kind:
        weights = [w / sum(weights) for w in weights]
    data = _spark().read.parquet(os.path.join(path, "data"))
    n = F.col("nodeData")
    out = data.select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["split"]["featureIndex"].alias("feature"),
        F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        n["prediction"].alias("value"), n["impurityStats"][0].alias("cover"), n["gain"].alias("gain"),
        (n["split"]["numCategories"] > 0).alias("categorical"))
    return out.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("tree") + 1))


def _spark():
    from pyspark.sql import SparkSession
    # a thread of its own has no active session
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def _flat(model) -> list[pd.DataFrame]:
    """The node tables of all trees, by number of node; as large as the model, which this process holds already."""
    nodes = node_table(model).toPandas()
    if nodes["categorical"].any():
        raise ValueError("trees with categorical splits are not supported")
    return [t.sort_values("node").reset_index(drop=True) for _, t in nodes.groupby("tree")]


class _Paths:
    """The leaves of all trees with as many different features on their paths: the value that a leaf adds, and for each
    feature the interval it must lie in and the share of the train rows that the splits on it let through."""

    def __init__(self, value, feature, low, high, share):
        self.value, self.feature, self.low, self.high, self.share = value, feature, low, high, share

    def pieces(self, most: int) -> Iterable[_Paths]:
        per = max(1, most // (8 + 32 * max(1, self.feature.shape[1])))
        for a in range(0, len(self.value), per):
            yield _Paths(*(x[a:a + per] for x in (self.value, self.feature, self.low, self.high, self.share)))


def _leaf_paths(trees: list[pd.DataFrame]) -> list[_Paths]:
    by_depth: dict[int, list] = {}
    for t in trees:
        feature, threshold, left, right, value, cover = (t[c].tolist() for c in ("feature", "threshold", "left", "right", "value", "cover"))
        weight = float(t["weight"][0])
        todo = [(0, {})]
        while todo:
            at, path = todo.pop()
            if left[at] < 0:
                by_depth.setdefault(len(path), []).append((weight * value[at], path))
                continue
            f, cut = feature[at], threshold[at]
            low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
            todo.append((left[at], {**path, f: (low, min(high, cut), share * cover[left[at]] / cover[at])}))
            todo.append((right[at], {**path, f: (max(low, cut), high, share * cover[right[at]] / cover[at])}))
    out = []
    for d, leaves in sorted(by_depth.items()):
        shape = (len(leaves), d)
        parts = [np.array([[p[i] for p in path.values()] for _, path in leaves], float).reshape(shape) for i in range(3)]
        out.append(_Paths(np.array([v for v, _ in leaves]), np.array([list(path) for _, path in leaves], np.int32).reshape(shape), *parts))
    return out


def expected_value(model) -> float:
    """The model's mean over its train rows, as its nodes have counted them: what Shapley values of trees start from."""
    return float(sum((p.value * p.share.prod(axis=1)).sum() for p in _leaf_paths(_flat(model))))


def _add_phi(phi: np.ndarray, x: np.ndarray, p: _Paths) -> None:
    """Add the Shapley values of the leaves ``p`` for the rows ``x``.

    With o = 1 where the row meets a feature's interval and z its share, a leaf's game is worth the product over its
    features of o (feature known) or z (not known). The Shapley value of feature j is (o_j - z_j) times the integral over t
    of the product of the other features' o t + z (1 - t): a polynomial of degree d - 1, which Gauss-Legendre nodes integrate
    exactly, and a sum of positive terms only."""
    d = p.feature.shape[1]
    if not d:
        return
    nodes, weights = np.polynomial.legendre.leggauss((d + 1) // 2)
    columns = x[:, p.feature]  # rows, leaves, features
    known = ((~(columns <= p.low)) & ((columns <= p.high) | np.isinf(p.high))).astype(float)
    total = np.zeros_like(known)
    for t, w in zip((nodes + 1) / 2, weights / 2):
        factor = known * t + p.share * (1 - t)
        total += w * factor.prod(axis=2, keepdims=True) / factor
    total *= (known - p.share) * p.value[:, None]
    flat, feature = total.reshape(len(x), -1), p.feature.reshape(-1)
    for j in np.unique(feature):
        phi[:, j] += flat[:, feature == j].sum(axis=1)


def shap_tree(model, rows: DataFrame, features: Sequence[str], row_id: str = "idx", piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Exact Shapley values of a forest or boosted model for every row (E4), as a tree explainer without background gives.

    Features that a coalition doesn't know follow both branches by the train rows' shares. Per row the values sum to
    the prediction less ``expected_value(model)``. Output (row_id, feature, phi).

    Leaves don't depend on each other: they are sent in pieces of at most ``piece_bytes``; one piece, the usual case, needs
    no shuffle, and several are summed by row id, which must then be unique. A missing (NaN) value goes right, as in
    prediction.
    """
    feats = list(features)
    if row_id in feats:
        raise ValueError("row_id must not be one of the features")
    spark, k = rows.sparkSession, len(feats)
    pieces: list[list[_Paths]] = [[]]
    room = piece_bytes
    for paths in _leaf_paths(_flat(model)):
        for part in paths.pieces(piece_bytes):
            size = part.feature.size * 32 + part.value.size * 8
            if size > room and pieces[-1]:
                pieces.append([])
                room = piece_bytes
            pieces[-1].append(part)
            room -= size
    # Arrow turns a NULL into NaN here, where MLlib would refuse it; rows are complete cases
    points = rows.select(row_id, *[F.col(f).cast("double").alias(f) for f in feats])
    schema = T.StructType([rows.schema[row_id], T.StructField("phi", T.ArrayType(T.DoubleType()))])

    def part_of(sent) -> Callable:
        def run(batches):
            for pdf in batches:
                x = pdf[feats].to_numpy(dtype=float)
                phi = np.zeros((len(x), k))
                for p in sent.value:
                    step = max(1, CELLS // max(1, p.feature.size))
                    for a in range(0, len(x), step):
                        _add_phi(phi[a:a + step], x[a:a + step], p)
                yield pd.DataFrame({row_id: pdf[row_id], "phi": list(phi)})
        return run

    out = None
    for piece in pieces:
        part = points.mapInPandas(part_of(spark.sparkContext.broadcast(piece)), schema)
        out = part if out is None else out.unionByName(part)
    names = F.array(*[F.lit(f) for f in feats])
    long = out.select(row_id, F.posexplode("phi").alias("_j", "phi")).select(row_id, F.element_at(names, F.col("_j") + 1).alias("feature"), "phi")
    return long if len(pieces) == 1 else long.groupBy(row_id, "feature").agg(F.sum("phi").alias("phi"))


# ---------------------------------------------------------------------------
# one forest, many settings
# ---------------------------------------------------------------------------

def _cut_values(tree: pd.DataFrame, x: np.ndarray, depths: Sequence[int]) -> np.ndarray:
    """The tree's predictions for the rows (depths, rows) as if it had been grown no deeper than each depth."""
    feature, threshold, left, right, value = (tree[c].to_numpy() for c in ("feature", "threshold", "left", "right", "value"))
    at, out = np.zeros(len(x), np.int64), np.empty((len(depths), len(x)))
    order, level = np.argsort(depths, kind="stable"), 0
    rows = np.arange(len(x))
    for i in order:
        while level < depths[i]:
            inner = left[at] >= 0
            if not inner.any():
                break
            f = feature[at]
            goes_left = x[rows, np.where(inner, f, 0)] <= threshold[at]
            at = np.where(inner, np.where(goes_left, left[at], right[at]), at)
            level += 1
        out[i] = value[at]
    return out


def _setting_sums(trees: Iterable[tuple[int, pd.DataFrame]], keyed: DataFrame, feats: list[str], counts: Sequence[int],
                  depths: Sequence[int], piece_bytes: int) -> DataFrame:
    """(_row, _y, _s: for every prefix and depth the sum of the predictions of those ``trees`` that are in the prefix), one
    row for each row of ``keyed`` and piece of trees. ``trees`` come with their place in the forest."""
    pieces, room = [], 0
    for i, t in trees:
        size = len(t) * 40
        if not pieces or size > room:
            pieces.append([])
            room = piece_bytes
        pieces[-1].append((i, t[["feature", "threshold", "left", "right", "value"]]))
        room -= size
    out = None
    for piece in pieces:
        sent = keyed.sparkSession.sparkContext.broadcast(piece)

        def run(batches, sent=sent):
            for pdf in batches:
                x = pdf[feats].to_numpy(dtype=float)
                sums = np.zeros((len(counts), len(depths), len(x)))
                for i, t in sent.value:
                    sums[[c > i for c in counts]] += _cut_values(t, x, depths)
                yield pd.DataFrame({"_row": pdf["_row"], "_y": pdf["_y"], "_s": list(sums.reshape(-1, len(x)).T)})
        part = keyed.mapInPandas(run, "_row long, _y double, _s array<double>")
        out = part if out is None else out.unionByName(part)
    return out


def _keyed(rows: DataFrame, feats: list[str], label: str) -> DataFrame:
    """The rows with a number each, stored: all pieces see the same."""
    from tidecast.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(rows.sparkSession)
    points = rows.select(F.monotonically_increasing_id().alias("_row"), F.col(label).cast("double").alias("_y"),
                         *[F.col(f).cast("double").alias(f) for f in feats])
    return points.checkpoint()


def _setting_errors(sums: DataFrame, counts: Sequence[int], depths: Sequence[int]) -> DataFrame:
    """(numTrees, maxDepth, n, sse), one row per setting, from the sums of all pieces."""
    cells = [(c, d) for c in counts for d in depths]
    by_row = sums.groupBy("_row", "_y").agg(*[F.sum(F.col("_s")[i]).alias(f"_s{i}") for i in range(len(cells))])
    total = by_row.agg(F.count("*").alias("n"), *[F.sum(F.pow(F.col(f"_s{i}") / c - F.col("_y"), 2)).alias(f"_s{i}") for i, (c, _d) in enumerate(cells)])
    return total.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("numTrees"), F.lit(d).alias("maxDepth"), F.col("n"), F.col(f"_s{i}").alias("sse")) for i, (c, d) in enumerate(cells)])))


def score_settings(model, rows: DataFrame, features: Sequence[str], label: str, num_trees: Sequence[int],
                   max_depth: Sequence[int], piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Squared errors of every (numTrees, maxDepth) over ``rows`` from one forest that has them all.

    A forest of fewer trees is a prefix of the forest, a shallower tree the tree cut at that depth, whose inner nodes hold
    their mean label. Output (numTrees, maxDepth, n, sse), one row per setting. Trees are sent in pieces, whose
    predictions are summed by row."""
    feats, counts = list(features), sorted(num_trees)
    trees = _flat(model)
    if counts[-1] > len(trees):
        raise ValueError(f"the forest has {len(trees)} trees")
    sums = _setting_sums(enumerate(trees[:counts[-1]]), _keyed(rows, feats, label), feats, counts, max_depth, piece_bytes)
    return _setting_errors(sums, counts, max_depth)


def tune_forest(df: DataFrame, features: Sequence[str], label: str = "close", grid: Mapping[str, Sequence] | None = None, folds: int = 3,
                fold: str = "expanding", idx: str = "idx", time_col: str = "date", seed: int = 42, grow: int = 25, parallelism: int = 4,
                refit: bool = True, on_fit: Callable[[str], None] | None = None, **params):
    """The forest grid search of ``models.tune`` with one forest per fold instead of one per setting and fold.

    The forest has the grid's most trees and greatest depth; every setting is scored from a prefix of its trees, cut at
    the setting's depth. Cut trees are the trees that a lower ``maxDepth`` grows but for the draws of features, so a
    setting's error agrees with a separately grown forest's within the spread between seeds. A forest is grown in parts of
    ``grow`` trees with seeds of their own, ``parallelism`` parts at a time; a part's trees are let go when its predictions are stored.
    ``fold`` is ``expanding``, ``time`` or ``random``, as in ``tune``. ``refit`` fits the best setting on all rows.
    Returns (best model or None, DataFrame of (params, rmse)); rmse is the mean over folds. ``on_fit`` is called after each part.
    """
    from multiprocessing.pool import ThreadPool

    from tidecast.operators.models import REFERENCE_RF_GRID, date_folds, fit
    from tidecast.session import ensure_checkpoint_dir
    grid = dict(grid or REFERENCE_RF_GRID)
    counts, depths = sorted(grid.pop("numTrees")), list(grid.pop("maxDepth"))
    if grid:
        raise ValueError(f"only numTrees and maxDepth can be scored from one forest, not {sorted(grid)}")
    if fold not in ("expanding", "time", "random"):
        raise ValueError(f"unknown fold {fold!r}")
    if folds < 2:
        raise ValueError("at least 2 folds")
    spark, feats = df.sparkSession, list(features)
    ensure_checkpoint_dir(spark)
    if fold == "random":
        data = df.withColumn("_fold", F.pmod(F.xxhash64(*df.columns, F.lit(seed)), F.lit(folds)).cast("int"))
    else:
        data = date_folds(df, folds, time_col if time_col in df.columns else idx, name="_fold")
    data = data.checkpoint(eager=True)
    splits = []
    for f in range(1 if fold == "expanding" else 0, folds):
        train = data.where(F.col("_fold") < f) if fold == "expanding" else data.where(F.col("_fold") != f)
        held = data.where(F.col("_fold") == f)
        if not held.isEmpty() and not train.isEmpty():
            splits.append((f, train, _keyed(held, feats, label)))
    if not splits:
        raise ValueError("no fold has rows to train and rows to score")

    def part(job):
        f, train, held, first = job
        n = min(grow, counts[-1] - first)
        m = fit(train, "rf", feats, label, numTrees=n, maxDepth=max(depths), seed=seed + first, **params)
        sums = _setting_sums(enumerate(_flat(m), first), held, feats, counts, depths, PIECE_BYTES)
        sums = sums.withColumn("_fold", F.lit(f)).checkpoint()
        if on_fit:
            on_fit(f"fold={f},trees={first}-{first + n - 1}")
        return f, sums

    jobs = [(f, train, held, first) for f, train, held in splits for first in range(0, counts[-1], grow)]
    with ThreadPool(parallelism) as pool:
        parts = pool.map(part, jobs, chunksize=1)
    found = []
    for f, _train, _held in splits:
        sums = None
        for g, s in parts:
            if g == f:
                sums = s if sums is None else sums.unionByName(s)
        # one row per setting
        found += [(r["numTrees"], r["maxDepth"], (r["sse"] / r["n"]) ** 0.5) for r in _setting_errors(sums, counts, depths).collect()]
    table = pd.DataFrame(found, columns=["numTrees", "maxDepth", "rmse"]).groupby(["numTrees", "maxDepth"], as_index=False)["rmse"].mean()
    best = table.loc[table["rmse"].idxmin()]
    model = fit(data.drop("_fold"), "rf", feats, label, numTrees=int(best["numTrees"]), maxDepth=int(best["maxDepth"]), seed=seed, **params) if refit else None
    out = [(f"maxDepth={int(r.maxDepth)},numTrees={int(r.numTrees)}", float(r.rmse)) for r in table.itertuples()]
    return model, spark.createDataFrame(out, "params string, rmse double")
