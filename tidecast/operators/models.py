"""Regressors, grouped least squares, evaluation, model choice and tuning."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.operators._chunks import as_list, join_on_keys, one_row, quantile_edges

# name -> estimator factory (M9). Unknown names raise instead of falling through.
MODELS: dict[str, Callable[..., object]] = {
    # solver "auto": normal equations up to the number of features they allow, else an iterative solver
    "lr": lambda **kw: LinearRegression(**{"regParam": 0.0, "solver": "auto", **kw}),
    "rf": lambda **kw: RandomForestRegressor(**{"numTrees": 3, "seed": 42, **kw}),
    "gbt": lambda **kw: GBTRegressor(**{"maxIter": 20, "seed": 42, **kw}),
}


# The grid search the reference runs (random forest, 30 random folds,
# 9 settings = 270 fits plus the refit): ``tune(df, "rf", features, grid=REFERENCE_RF_GRID,
# folds=REFERENCE_FOLDS, fold="random")``. The registered query uses a smaller grid.
REFERENCE_RF_GRID = {"numTrees": [50, 100, 150], "maxDepth": [5, 10, 15]}
REFERENCE_FOLDS = 30


def model_choice(name: str, **params):
    """The estimator registered under ``name`` (M9)."""
    try:
        factory = MODELS[name]
    except KeyError:
        raise ValueError(f"unknown model {name!r}; choose one of {sorted(MODELS)}") from None
    return factory(**params)


def assemble(df: DataFrame, features: Sequence[str], out: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """Numeric columns to one vector column (V1). NULL raises unless ``handle_invalid`` says otherwise."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid=handle_invalid).transform(df)


def make_pipeline(kind: str, features: Sequence[str], label: str = "close", **params) -> Pipeline:
    """Assembler + model as one estimator (M4)."""
    est = model_choice(kind, featuresCol="features", labelCol=label, **params)
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), est])


def fit(df: DataFrame, kind: str, features: Sequence[str], label: str = "close", **params) -> PipelineModel:
    """Fit a pipeline of assembler + ``kind`` on ``df`` (M1-M4).

    The shared checkpoint folder is registered first, so iterative learners
    (boosting, deep trees) cut their lineage there instead of keeping it whole.
    """
    from tidecast.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return make_pipeline(kind, features, label, **params).fit(df)


def predict(model, df: DataFrame, keep_features: bool = False) -> DataFrame:
    """Add ``prediction`` (M5)."""
    out = model.transform(df)
    return out if keep_features else out.drop("features")


def evaluate(df: DataFrame, metric: str | Sequence[str] = "rmse", label: str = "close",
             prediction: str = "prediction", by=()) -> DataFrame:
    """RMSE / R² / MAE per key as one aggregate (M6, M7)."""
    by = as_list(by)
    # rows that lack a label or a prediction take no part in any metric
    scored = F.col(label).isNotNull() & F.col(prediction).isNotNull()
    y, p = F.when(scored, F.col(label)), F.when(scored, F.col(prediction))
    err2 = F.pow(y - p, 2)
    exprs = {
        "rmse": F.sqrt(F.avg(err2)),
        "mse": F.avg(err2),
        "mae": F.avg(F.abs(y - p)),
        # a constant target has no variance: 1 if the residuals vanish too, else 0 (the usual convention)
        "r2": F.coalesce(F.lit(1.0) - F.try_divide(F.sum(err2), F.var_pop(y) * F.count(y)),
                         F.when(F.sum(err2) == 0, F.lit(1.0)).otherwise(F.lit(0.0))),
    }
    aggs = [exprs[m].alias(m) for m in as_list(metric)]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def compare_models(train: DataFrame, test: DataFrame, kinds: Sequence[str], features: Sequence[str],
                   label: str = "close", metric="rmse", params: Mapping[str, dict] | None = None,
                   keys: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Fit each model, score the test part, and report the metric side by side (M8).

    Returns (predictions with a ``model`` column, metric per model).
    """
    preds = None
    for k in kinds:
        m = fit(train, k, features, label, **(params or {}).get(k, {}))
        p = predict(m, test).select(*keys, label, "prediction").withColumn("model", F.lit(k))
        preds = p if preds is None else preds.unionByName(p)
    return preds, evaluate(preds, metric, label, by=["model"])


# ---------------------------------------------------------------------------
# one least-squares model per key, fully distributed
# ---------------------------------------------------------------------------

def fit_grouped_linear(df: DataFrame, features: Sequence[str], label: str = "close", by=()) -> DataFrame:
    """Ordinary least squares per key from grouped second moments (M1 for many symbols).

    One aggregation gives, per key, the means and the population covariances
    of features and label (Spark's covariance aggregates merge partial states
    stably, and a hot key is pre-reduced in every task). The k×k system is then
    solved row by row on this small table with ``mapInPandas``: no shuffle, no
    driver loop over keys. With one feature the slope is the closed form
    ``covar_pop(x, y) / var_pop(x)``, evaluated in the JVM.

    Only rows with a label and all features take part (no NULL, no NaN); ``n`` counts them.

    Output: ``by..., n, intercept, coef_<feature>...``.
    """
    return solve_linear(linear_moments(df, features, label, by), features, by)


def linear_moments(df: DataFrame, features: Sequence[str], label: str = "close", by=()) -> DataFrame:
    """What least squares needs of the rows, one row per key: by..., n, the means ``_m<i>`` and ``_my``, and the population
    covariances ``_c<i>_<j>`` and ``_cy<i>``. Rows without a label or a feature take no part."""
    by, feats = as_list(by), list(features)
    k = len(feats)
    df = df.dropna(subset=[label, *feats])
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(label).alias("_my")]
    aggs += [F.avg(f).alias(f"_m{i}") for i, f in enumerate(feats)]
    aggs += [F.covar_pop(feats[i], feats[j]).alias(f"_c{i}_{j}") for i in range(k) for j in range(i, k)]
    aggs += [F.covar_pop(f, label).alias(f"_cy{i}") for i, f in enumerate(feats)]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def merge_moments(mom: DataFrame, features: Sequence[str], by=()) -> DataFrame:
    """Rows of ``linear_moments`` that share a key (of several periods or tables) merged into one.

    The merged covariance is the mean of the parts' covariances and of the products of their means' distances from the merged
    mean, each by the parts' counts: sums of centred products, which lose no digits to large values. The merged mean is joined
    back to the parts, a table of one row per key and period."""
    by, k = as_list(by), len(features)
    means = ["_my", *[f"_m{i}" for i in range(k)]]
    mom = mom.where("n > 0")
    total = [F.sum("n").alias("_N"), *[(F.sum(F.col("n") * F.col(m)) / F.sum("n")).alias(f"_t{m}") for m in means]]
    if by:
        met = join_on_keys(mom, mom.groupBy(*by).agg(*total), by)
    else:
        row = one_row(mom.agg(*total))
        met = mom.withColumns({c: row[c] for c in ["_N", *[f"_t{m}" for m in means]]})
    off = lambda m: F.col(m) - F.col(f"_t{m}")
    pooled = lambda c, a, b: (F.sum(F.col("n") * (F.col(c) + off(a) * off(b))) / F.first("_N")).alias(c)
    aggs = [F.first("_N").alias("n"), *[F.first(f"_t{m}").alias(m) for m in means]]
    aggs += [pooled(f"_c{i}_{j}", f"_m{i}", f"_m{j}") for i in range(k) for j in range(i, k)]
    aggs += [pooled(f"_cy{i}", f"_m{i}", "_my") for i in range(k)]
    return met.groupBy(*by).agg(*aggs) if by else met.agg(*aggs)


def store_moments(df: DataFrame, path: str, features: Sequence[str], label: str, by, period: str) -> None:
    """Write the moments of every (key, period) of ``df`` to the table at ``path``; ``period`` is a column of ``df``.

    A period is written whole: given again, for late rows or after a failure, it replaces what is stored of it, and
    the others stay. So new days refit a model (``refit_linear``) without a scan of the old rows."""
    mom = linear_moments(df, features, label, [*as_list(by), period])
    # all rows of a period in one file: a period has one row per key
    mom.repartition(period).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(period).parquet(path)


def refit_linear(spark, path: str, features: Sequence[str], by=(), where=None) -> DataFrame:
    """Coefficients as of ``fit_grouped_linear`` from stored moments alone, of all periods or those that meet ``where``."""
    mom = spark.read.parquet(path)
    return solve_linear(merge_moments(mom if where is None else mom.where(where), features, by), features, by)


def solve_linear(mom: DataFrame, features: Sequence[str], by=()) -> DataFrame:
    """Least squares from the rows of ``linear_moments``, key by key."""
    by, feats = as_list(by), list(features)
    k = len(feats)
    coef_names = [f"coef_{f}" for f in feats]
    if k == 1:
        slope = F.try_divide(F.col("_cy0"), F.col("_c0_0"))
        out = mom.select(*by, "n", (F.col("_my") - slope * F.col("_m0")).alias("intercept"),
                         slope.alias(coef_names[0]))
        return out
    schema = T.StructType([*[mom.schema[b] for b in by], T.StructField("n", T.LongType()),
                           T.StructField("intercept", T.DoubleType()),
                           *[T.StructField(c, T.DoubleType()) for c in coef_names]])

    def solve(batches):
        # one batched pseudo-inverse per Arrow batch of keys (singular systems get the
        # minimum-norm solution, as lstsq would)
        for pdf in batches:
            cxx = np.empty((len(pdf), k, k))
            for i in range(k):
                for j in range(i, k):
                    cxx[:, i, j] = cxx[:, j, i] = pdf[f"_c{i}_{j}"].to_numpy(dtype=float)
            cxy = np.stack([pdf[f"_cy{i}"].to_numpy(dtype=float) for i in range(k)], axis=1)
            beta = (np.linalg.pinv(cxx) @ cxy[:, :, None])[:, :, 0]
            mx = np.stack([pdf[f"_m{i}"].to_numpy(dtype=float) for i in range(k)], axis=1)
            out = pdf[by].copy() if by else pd.DataFrame(index=pdf.index)
            out["n"] = pdf["n"].astype("int64")
            out["intercept"] = pdf["_my"].to_numpy(dtype=float) - (beta * mx).sum(axis=1)
            for i, c in enumerate(coef_names):
                out[c] = beta[:, i]
            yield out[[f.name for f in schema.fields]]

    return mom.mapInPandas(solve, schema)


def predict_grouped_linear(coefs: DataFrame, df: DataFrame, features: Sequence[str], by=(),
                           name: str = "prediction") -> DataFrame:
    """Score rows with their key's coefficients (M5 for grouped models)."""
    by = as_list(by)
    c = coefs.select(*by, "intercept", *[F.col(f"coef_{f}") for f in features])
    if by:
        out = join_on_keys(df, c, by)
        coef = lambda f: F.col(f"coef_{f}")
        icpt = F.col("intercept")
    else:
        out = df
        row = one_row(c)
        coef = lambda f: row[f"coef_{f}"]
        icpt = row["intercept"]
    pred = icpt
    for f in features:
        pred = pred + coef(f) * F.col(f)
    return out.withColumn(name, pred).select(*df.columns, name)


def fit_predict_linear_window(df: DataFrame, feature: str, label: str = "close", by=(),
                              fit_on: str = "is_train", name: str = "prediction") -> DataFrame:
    """One-feature least squares per key, fitted on ``fit_on`` rows and applied to every row, in one pass.

    The moments are window aggregates over the key restricted to train rows
    (``when(fit_on, ...)``), so when the frame is already partitioned by the
    key (after a fill or an index) this adds no shuffle, no join, and no second
    evaluation of the input: a groupBy + join would plan the input twice.
    Equal to :func:`fit_grouped_linear` + :func:`predict_grouped_linear`.
    """
    by = as_list(by)
    if not by:
        # no key: the same model from one aggregate read as scalars (no single-task window)
        c = fit_grouped_linear(df.where(F.col(fit_on)), [feature], label)
        return predict_grouped_linear(c, df, [feature], name=name)
    w = Window.partitionBy(*by)
    both = (F.col(fit_on) & F.col(feature).isNotNull() & F.col(label).isNotNull()
            & ~F.isnan(feature) & ~F.isnan(label))
    x = F.when(both, F.col(feature))
    y = F.when(both, F.col(label))
    slope = F.try_divide(F.covar_pop(x, y).over(w), F.var_pop(x).over(w))
    icpt = F.avg(y).over(w) - slope * F.avg(x).over(w)
    return df.withColumn(name, icpt + slope * F.col(feature))


def linear_coefficients(model: PipelineModel, features: Sequence[str]) -> dict[str, float]:
    """Coefficients and intercept of a fitted linear pipeline (small: one value per feature)."""
    lr = model.stages[-1]
    out = {f"coef_{f}": float(v) for f, v in zip(features, lr.coefficients.toArray())}
    out["intercept"] = float(lr.intercept)
    return out


def time_folds(df: DataFrame, folds: int, idx: str = "idx", by=(), name: str = "fold") -> DataFrame:
    """Fold number from contiguous time blocks of the index, per key."""
    by = as_list(by)
    n = (F.max(idx).over(Window.partitionBy(*by)) if by else df.agg(F.max(idx)).scalar()) + 1
    return df.withColumn(name, F.floor(F.col(idx) * F.lit(folds) / n).cast("int"))


def date_folds(df: DataFrame, folds: int, time_col: str = "date", name: str = "fold") -> DataFrame:
    """Fold number from blocks of time that hold for all keys alike: all rows of a date share a fold, and no row of
    a later fold is older than a row of an earlier one. Blocks are cut at approximate quantiles of the rows' times."""
    edges = quantile_edges(df, time_col, folds)
    if edges is None:
        return df.withColumn(name, F.lit(0))
    return df.withColumn(name, F.size(F.filter(edges, lambda e: e < F.col(time_col))))


def tune(df: DataFrame, kind: str, features: Sequence[str], label: str = "close",
         grid: Mapping[str, Sequence] | None = None, folds: int = 3, fold: str = "expanding",
         idx: str = "idx", by=(), parallelism: int = 2, seed: int = 42, time_col: str = "date",
         on_fit: Callable[[str], None] | None = None):
    """Grid search with k-fold cross-validation, best by RMSE, refit on all rows.

    ``fold='expanding'`` for block f = 1..k-1, train on blocks before f and validate on f; blocks
                         are cut by time over all keys, so no fit sees a row later than what it scores
    ``fold='time'``      the same blocks as folds, each against all others (sees the future)
    ``fold='random'``    random folds, for parity with the reference
    The input is written once to the shared checkpoint folder; all fits read that, ``parallelism``
    at a time. Returns (best model, DataFrame of (params, rmse)). ``on_fit(params)`` is called after each fit of
    expanding folds, on the thread that made it; the refit is not one of them.
    """
    from multiprocessing.pool import ThreadPool

    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    from tidecast.session import ensure_checkpoint_dir

    if fold not in ("expanding", "time", "random"):
        raise ValueError(f"unknown fold {fold!r}")
    if fold == "expanding" and folds < 2:
        raise ValueError("expanding folds need at least 2 blocks")
    ensure_checkpoint_dir(df.sparkSession)
    pipe = make_pipeline(kind, features, label)
    est = pipe.getStages()[-1]
    builder = ParamGridBuilder()
    for p, vals in (grid or {}).items():
        builder = builder.addGrid(est.getParam(p), list(vals))
    maps = builder.build()
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
    spark = df.sparkSession

    def label_of(m):
        return ",".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda kv: kv[0].name))

    if fold != "random":
        df = date_folds(df, folds, time_col if time_col in df.columns else idx, name="_fold")
    data = df.checkpoint(eager=True)
    if fold == "expanding":
        def one(job):
            m, f = job
            fitted = pipe.copy(m).fit(data.where(F.col("_fold") < f))
            if on_fit:
                on_fit(label_of(m))
            return ev.evaluate(fitted.transform(data.where(F.col("_fold") == f)))

        # grid x (folds - 1) distributed fits, driven from here like CrossValidator's
        jobs = [(m, f) for m in maps for f in range(1, folds)]
        with ThreadPool(parallelism) as pool:
            rmses = pool.map(one, jobs, chunksize=1)
        per = folds - 1
        scores = [sum(rmses[i * per:(i + 1) * per]) / per for i in range(len(maps))]
        best = min(range(len(maps)), key=lambda i: scores[i])
        best_model = pipe.copy(maps[best]).fit(data)
        rows = [(label_of(m), float(r)) for m, r in zip(maps, scores)]
        return best_model, spark.createDataFrame(rows, "params string, rmse double")
    kw = dict(estimator=pipe, estimatorParamMaps=maps, evaluator=ev, numFolds=folds,
              parallelism=parallelism, seed=seed)
    if fold == "time":
        kw["foldCol"] = "_fold"
    cvm = CrossValidator(**kw).fit(data)
    rows = [(label_of(m), float(r)) for m, r in zip(maps, cvm.avgMetrics)]
    return cvm.bestModel, spark.createDataFrame(rows, "params string, rmse double")


def vector_column_to_array(df: DataFrame, col: str = "features", name: str | None = None) -> DataFrame:
    """Vector column as array<double>, for storage or comparison."""
    return df.withColumn(name or col, vector_to_array(F.col(col)))
