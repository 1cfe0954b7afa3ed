"""Explanations: importances, Shapley values, local surrogates.

All scoring of perturbed points is one batched ``transform`` over a
DataFrame of points, never a Python callback per point. Random draws come
from hashes of (row, sample, feature, seed), so re-evaluation of any
partition reproduces the same numbers.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.operators._chunks import as_list, join_on_keys, one_row
from tidecast.operators.index import row_index

_TWO31 = float(1 << 31)


def importances(spark: SparkSession, model, features: Sequence[str], name: str = "model") -> DataFrame:
    """Tree feature importances as (model, feature, importance) (E1). Sums to 1; linear models have none."""
    stage = model.stages[-1] if hasattr(model, "stages") else model
    if not hasattr(stage, "featureImportances"):
        raise ValueError("model has no feature importances (linear models do not)")
    vals = stage.featureImportances.toArray()
    rows = [(name, f, float(v)) for f, v in zip(features, vals)]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


def _long(df: DataFrame, keys: Sequence[str], features: Sequence[str], prefix: str, value: str) -> DataFrame:
    """Wide ``<prefix><feature>`` columns to (keys..., feature, value)."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"{prefix}{f}").alias(value)) for f in features])
    return df.select(*keys, F.inline(pairs))


def shap_linear(coefs: DataFrame | Mapping[str, float], background: DataFrame, rows: DataFrame,
                features: Sequence[str], row_id: str = "idx", by=()) -> DataFrame:
    """Exact Shapley values of a linear model: ``coef_j * (x_j - mean_background_j)``.

    ``coefs``: a table from ``fit_grouped_linear`` (per key) or a dict
    ``{"coef_<f>": value}`` for one model. Output (by..., row_id, feature, phi).
    """
    by = as_list(by)
    feats = list(features)
    means_aggs = [F.avg(f).alias(f"_mu_{f}") for f in feats]
    if by:
        means = background.groupBy(*by).agg(*means_aggs)
        out = join_on_keys(rows.select(*by, row_id, *feats), means, by)
        mu = lambda f: F.col(f"_mu_{f}")
    else:
        means = one_row(background.agg(*means_aggs))
        out = rows.select(row_id, *feats)
        mu = lambda f: means[f"_mu_{f}"]
    if isinstance(coefs, DataFrame):
        out = join_on_keys(out, coefs.select(*by, *[f"coef_{f}" for f in feats]), by) if by else \
            out.withColumns({f"coef_{f}": one_row(coefs.select(*[f"coef_{f}" for f in feats]))[f"coef_{f}"]
                             for f in feats})
        cf = lambda f: F.col(f"coef_{f}")
    else:
        cf = lambda f: F.lit(float(coefs[f"coef_{f}"]))
    out = out.select(*by, row_id, *[(cf(f) * (F.col(f) - mu(f))).alias(f"_phi_{f}") for f in feats])
    return _long(out, [*by, row_id], feats, "_phi_", "phi")


def shap_summary(attr: DataFrame, by=(), value: str = "phi") -> DataFrame:
    """Mean absolute attribution per feature (E5)."""
    return attr.groupBy(*as_list(by), "feature").agg(F.avg(F.abs(value)).alias("mean_abs_phi"))


def _uniform(*cols) -> F.Column:
    """Uniform (0, 1) draw from a hash of the given columns."""
    return (F.pmod(F.xxhash64(*cols), F.lit(1 << 31)).cast("double") + 1.0) / (_TWO31 + 1.0)


def _normal(*cols) -> F.Column:
    """Standard normal draw (Box-Muller) from two hashed uniforms."""
    u1 = _uniform(*cols, F.lit(1))
    u2 = _uniform(*cols, F.lit(2))
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def lime(model, train: DataFrame, rows: DataFrame, features: Sequence[str], row_id: str = "idx",
         n_samples: int = 500, seed: int = 42, kernel_width: float | None = None,
         top_k: int | None = None) -> DataFrame:
    """Local linear surrogate around each row (E2), for many rows at once.

    Samples ``x + std * z`` (z standard normal per feature, sample 0 = the row
    itself) with the train standard deviations, scores every sample with one
    ``transform``, weights them by ``sqrt(exp(-|z|² / width²))`` (width
    defaults to ``0.75 * sqrt(k)``), and fits a weighted least-squares line per
    row from grouped weighted moments. Weights are reported per original unit,
    so a linear model's coefficients are recovered. Each row's group holds
    ``n_samples`` points, a bound set by the caller.

    Output (row_id, feature, weight) plus the surrogate's ``intercept`` per row
    as feature ``'(intercept)'``; ``top_k`` keeps the k largest |weight| per row.
    """
    feats = list(features)
    if row_id in feats:
        raise ValueError("row_id must not be one of the features")
    k = len(feats)
    width = kernel_width or 0.75 * math.sqrt(k)
    std = one_row(train.agg(*[F.stddev_samp(f).alias(f) for f in feats]))
    sd = {f: F.coalesce(std[f], F.lit(0.0)) for f in feats}
    base = rows.select(row_id, *feats).withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1))))
    z = {f: F.when(F.col("_s") == 0, F.lit(0.0)).otherwise(
        _normal(F.col(row_id), F.col("_s"), F.lit(j), F.lit(seed))) for j, f in enumerate(feats)}
    pts = base.select(row_id, "_s", *[z[f].alias(f"_z{j}") for j, f in enumerate(feats)],
                      *[(F.col(f) + z[f] * sd[f]).alias(f) for f in feats])
    scored = model.transform(pts).select(row_id, *[f"_z{j}" for j in range(k)], F.col("prediction").alias("_y"))
    d2 = sum((F.col(f"_z{j}") * F.col(f"_z{j}") for j in range(k)), F.lit(0.0))
    scored = scored.withColumn("_w", F.sqrt(F.exp(-d2 / F.lit(width * width))))
    zs = ["_one", *[f"_z{j}" for j in range(k)]]
    scored = scored.withColumn("_one", F.lit(1.0))
    aggs = [F.sum(F.col("_w") * F.col(zs[a]) * F.col(zs[b])).alias(f"_g{a}_{b}")
            for a in range(k + 1) for b in range(a, k + 1)]
    aggs += [F.sum(F.col("_w") * F.col(zs[a]) * F.col("_y")).alias(f"_h{a}") for a in range(k + 1)]
    mom = scored.groupBy(row_id).agg(*aggs)
    # per-unit scale of each feature, needed to turn z-slopes into x-slopes
    mom = mom.withColumns({f"_sd{j}": sd[f] for j, f in enumerate(feats)})
    id_field = rows.schema[row_id]
    schema = T.StructType([T.StructField(row_id, id_field.dataType), T.StructField("feature", T.StringType()),
                           T.StructField("weight", T.DoubleType())])

    def solve(batches):
        # batched weighted least squares: one pseudo-inverse per Arrow batch of rows
        for pdf in batches:
            n = len(pdf)
            g = np.empty((n, k + 1, k + 1))
            for a in range(k + 1):
                for b in range(a, k + 1):
                    g[:, a, b] = g[:, b, a] = pdf[f"_g{a}_{b}"].to_numpy(dtype=float)
            h = np.stack([pdf[f"_h{a}"].to_numpy(dtype=float) for a in range(k + 1)], axis=1)
            beta = (np.linalg.pinv(g) @ h[:, :, None])[:, :, 0]
            sdv = np.stack([pdf[f"_sd{j}"].to_numpy(dtype=float) for j in range(k)], axis=1)
            with np.errstate(divide="ignore", invalid="ignore"):
                per_unit = np.where(sdv > 0, beta[:, 1:] / sdv, 0.0)
            ids = pdf[row_id].to_numpy()
            feats_col = np.array(["(intercept)", *feats], dtype=object)
            yield pd.DataFrame({
                row_id: np.repeat(ids, k + 1),
                "feature": np.tile(feats_col, n),
                "weight": np.concatenate([beta[:, :1], per_unit], axis=1).reshape(-1),
            })

    res = mom.mapInPandas(solve, schema)
    if top_k:
        w = Window.partitionBy(row_id).orderBy(F.desc(F.abs("weight")), "feature")
        res = res.where(F.col("feature") != "(intercept)").withColumn("_r", F.row_number().over(w)) \
            .where(F.col("_r") <= top_k).drop("_r")
    return res


def shap_sampled(model, background: DataFrame, rows: DataFrame, features: Sequence[str], row_id: str = "idx",
                 n_perm: int = 32, seed: int = 42) -> DataFrame:
    """Shapley values by permutation sampling (E4), model-agnostic (for example trees).

    For each (row, permutation) a background row is drawn by hash and joined on
    its dense index (equi-join; draws are uniform so no background row is hot).
    Features switch from the background value to the row's value in the
    permutation's order; the k + 1 points are scored in one ``transform`` and
    each feature gets the change it caused. Averages over permutations give
    phi; per row they sum to ``f(x) - mean f(background draws)``.
    Output (row_id, feature, phi).
    """
    feats = list(features)
    if row_id in feats:
        raise ValueError("row_id must not be one of the features")
    k = len(feats)
    # dense background index without a global sort: order by a hash, chunked by its bucket
    h = F.xxhash64(*[F.col(f) for f in feats], F.lit(seed))
    n_buckets = background.agg(F.ceil((F.count(F.lit(1)) + 1) / F.lit(4096))).scalar()  # grows with the background
    bg = background.select(*feats).withColumns({"_h": h, "_b": F.pmod(h, n_buckets)})
    bg = row_index(bg, ["_b", "_h", *feats], name="_bi", chunk=F.col("_b")).drop("_h", "_b")
    n_bg = bg.agg(F.count(F.lit(1))).scalar()
    pairs = rows.select(row_id, *[F.col(f).alias(f"_x{j}") for j, f in enumerate(feats)]) \
        .withColumn("_perm", F.explode(F.sequence(F.lit(0), F.lit(n_perm - 1))))
    pairs = pairs.withColumn("_bi", F.pmod(F.xxhash64(F.col(row_id), F.col("_perm"), F.lit(seed)), n_bg))
    bgx = bg.select("_bi", *[F.col(f).alias(f"_b{j}") for j, f in enumerate(feats)])
    pairs = pairs.join(bgx, "_bi", "inner")
    # the permutation: feature indices sorted by a hash of (row, permutation, feature)
    keyed = F.array(*[F.struct(F.xxhash64(F.col(row_id), F.col("_perm"), F.lit(j), F.lit(seed + 1)).alias("h"),
                               F.lit(j).alias("j")) for j in range(k)])
    pairs = pairs.withColumn("_order", F.transform(F.array_sort(keyed), lambda e: e["j"]))
    # step t switches the features at positions < t of the permutation from background to row values
    pts = pairs.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(k))))
    switched = F.slice(F.col("_order"), 1, F.col("_t"))
    pts = pts.select(row_id, "_perm", "_t", "_order", *[
        F.when(F.array_contains(switched, j), F.col(f"_x{j}")).otherwise(F.col(f"_b{j}")).alias(f)
        for j, f in enumerate(feats)])
    scored = model.transform(pts).select(row_id, "_perm", "_t", "_order", "prediction")
    # per (row, permutation): the k + 1 predictions in step order (a bounded group), then the
    # change at step t goes to the feature at position t of the permutation. Array functions
    # instead of a lag window + filter: a filter above the wide projection makes Catalyst's
    # constraint inference explode on this plan.
    g = scored.groupBy(row_id, "_perm", "_order").agg(
        F.array_sort(F.collect_list(F.struct("_t", "prediction"))).alias("_ps"))
    names = F.array(*[F.lit(f) for f in feats])
    steps = F.sequence(F.lit(1), F.lit(k))
    contrib = F.transform(steps, lambda t: F.struct(
        F.element_at(names, F.element_at(F.col("_order"), t) + 1).alias("feature"),
        (F.element_at(F.col("_ps"), t + 1)["prediction"] - F.element_at(F.col("_ps"), t)["prediction"]).alias("_d")))
    scored = g.select(row_id, F.inline(contrib))
    return scored.groupBy(row_id, "feature").agg(F.avg("_d").alias("phi"))


# Coefficients of Wichura's rational approximation (AS 241) of the normal quantile.
_CENTRE = ((3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
            4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
           (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3, 2.1213794301586595867e4,
            3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3))
_NEAR = ((1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
          1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
         (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1, 1.48103976427480074590e-1,
          1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9))
_FAR = ((6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
         2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
        (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2, 7.86869131145613259100e-4,
         1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15))


def _ratio(r: str, tables) -> str:
    """SQL of a quotient of two polynomials in r, lowest power first."""
    def poly(cs):
        out = f"{cs[-1]!r}D"
        for c in reversed(cs[:-1]):
            out = f"({out} * {r} + {c!r}D)"
        return out
    return f"({poly(tables[0])} / {poly(tables[1])})"


def _tail(u: F.Column) -> F.Column:
    return F.sqrt(-F.log(F.least(u, 1.0 - u)))


def normal_quantile(u: str, r: str) -> F.Column:
    """The standard normal quantile of the column u in (0, 1), to about 16 digits, from built-in functions; the column
    ``r`` holds ``_tail(u)``. Both are columns as they are used many times; SQL text saves hundreds of calls."""
    tail = f"CASE WHEN {r} <= 5.0D THEN {_ratio(f'({r} - 1.6D)', _NEAR)} ELSE {_ratio(f'({r} - 5.0D)', _FAR)} END"
    q = f"({u} - 0.5D)"
    return F.expr(f"CASE WHEN abs({q}) <= 0.425D THEN {q} * {_ratio(f'(0.180625D - {q} * {q})', _CENTRE)} "
                  f"WHEN {q} < 0 THEN -({tail}) ELSE {tail} END")


def _phi(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


def lime_quartile(model, train: DataFrame, rows: DataFrame, features: Sequence[str], row_id: str = "idx",
                  n_samples: int = 5000, seed: int = 42, kernel_width: float | None = None,
                  num_features: int = 10, alpha: float = 1.0, accuracy: int = 10000) -> DataFrame:
    """``lime_quartile_models`` of one model: (row_id, feature, condition, weight)."""
    out = lime_quartile_models({"model": model}, train, rows, features, row_id, n_samples, seed, kernel_width, num_features, alpha, accuracy)
    return out.drop("model")


def lime_quartile_models(fitted: Mapping[str, object], train: DataFrame, rows: DataFrame, features: Sequence[str], row_id: str = "idx",
                         n_samples: int = 5000, seed: int = 42, kernel_width: float | None = None,
                         num_features: int = 10, alpha: float = 1.0, accuracy: int = 10000) -> DataFrame:
    """Local surrogate with quartile-discretized features, the common tabular default.

    Per feature, train quartiles (``percentile_approx``, a mergeable sketch)
    cut values into four bins. Each sample draws a bin per feature with the
    bins' train frequencies and a value from the bin's truncated normal
    (sample 0 is the row itself); the surrogate sees 1 where the sample's bin
    equals the row's. Weights are ``sqrt(exp(-d² / width²))`` on that binary
    representation. ``num_features`` of the features are kept if there are
    more: up to six by forward selection (each time the one that raises the
    weighted R² most), else those with the largest |coefficients| of a weighted
    ridge (alpha 0.01); the answer is a weighted ridge (``alpha``, free
    intercept) on them. All draws are hashes of (row, sample, feature, seed).

    ``fitted`` maps names to models: all of them score the same samples, which are drawn once and pass through in one
    go. A task sums the products of its samples as one matrix per explained row; a group then holds a row's matrices.

    Output (row_id, model, feature, condition, weight), conditions such as
    ``"12.50 < open <= 20.00"``.
    """
    feats = list(features)
    if row_id in feats:
        raise ValueError("row_id must not be one of the features")
    k, n_models = len(feats), len(fitted)
    width = kernel_width or 0.75 * math.sqrt(k)
    # the explainer's parameters, fitted on train like a model's: 3 quartile edges per
    # feature and at most 4 bins per feature (bounded by the feature count, not the data),
    # computed by two aggregations and then used as literals
    qrow = train.agg(*[F.percentile_approx(f, [0.25, 0.5, 0.75], accuracy).alias(f) for f in feats]).first()
    edges = {f: [float(x) for x in qrow[f]] for f in feats}

    def bin_of(x, f):
        e = edges[f]
        return F.when(x <= e[0], 0).when(x <= e[1], 1).when(x <= e[2], 2).otherwise(3)

    longv = train.select(F.inline(F.array(*[
        F.struct(F.lit(j).alias("j"), bin_of(F.col(f), f).alias("b"), F.col(f).cast("double").alias("v"))
        for j, f in enumerate(feats)])))
    bs = longv.groupBy("j", "b").agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("mu"),
                                     F.stddev_pop("v").alias("sd"), F.min("v").alias("lo"),
                                     F.max("v").alias("hi")).collect()
    tot = {j: sum(r.n for r in bs if r.j == j) for j in range(k)}
    stat = {}
    for r in bs:
        sd = r.sd or 0.0
        stat[r.j, r.b] = {"n": r.n, "mu": r.mu, "sd": sd, "lo": r.lo, "hi": r.hi,
                          "pa": _phi((r.lo - r.mu) / sd) if sd else 0.0, "pb": _phi((r.hi - r.mu) / sd) if sd else 1.0}
    cfs = {}
    for j in range(k):
        acc, cf = 0, []
        for b in range(4):
            acc += stat[(j, b)]["n"] if (j, b) in stat else 0
            cf.append(acc / tot[j] if tot[j] else 1.0)
        cfs[j] = cf

    def bin_param(j, name):
        whens = "".join(f" WHEN {b} THEN {float(stat[j, b][name])!r}D" for b in range(4) if (j, b) in stat and stat[j, b][name] is not None)
        return F.expr(f"CASE _b{j}{whens} END" if whens else "CAST(NULL AS DOUBLE)").cast("double")

    base = rows.select(row_id, *feats).withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1))))
    stage1 = {}
    for j, f in enumerate(feats):
        u = _uniform(F.col(row_id), F.col("_s"), F.lit(j), F.lit(seed))
        cf = cfs[j]
        stage1[f"_i{j}"] = bin_of(F.col(f), f)
        stage1[f"_d{j}"] = F.when(u < cf[0], 0).when(u < cf[1], 1).when(u < cf[2], 2).otherwise(3)
    base = base.withColumns(stage1)
    base = base.withColumns({f"_b{j}": F.when(F.col("_s") == 0, F.col(f"_i{j}")).otherwise(F.col(f"_d{j}"))
                             for j in range(k)})
    base = base.withColumns({f"_{p}{j}": bin_param(j, name)
                             for j in range(k) for p, name in ((x, x) for x in ("mu", "sd", "lo", "hi", "pa", "pb"))})
    # one uniform draw between the bin's ends on the scale of probabilities, then the quantile: an exact draw from the
    # truncated normal (a bin without spread gives its mean); columns of their own, as they are used many times
    base = base.withColumns({f"_u{j}": F.col(f"_pa{j}") + _uniform(F.col(row_id), F.col("_s"), F.lit(j), F.lit(seed), F.lit(100))
                             * (F.col(f"_pb{j}") - F.col(f"_pa{j}")) for j in range(k)})
    base = base.withColumns({f"_r{j}": _tail(F.col(f"_u{j}")) for j in range(k)})
    vals = {}
    for j, f in enumerate(feats):
        z = normal_quantile(f"_u{j}", f"_r{j}")
        drawn = F.least(F.greatest(F.col(f"_mu{j}") + F.col(f"_sd{j}") * z, F.col(f"_lo{j}")), F.col(f"_hi{j}"))
        v = F.when(F.col(f"_sd{j}") > 0, drawn).otherwise(F.col(f"_mu{j}"))
        vals[f] = F.when(F.col("_s") == 0, F.col(f).cast("double")).otherwise(v)
    zcols = {f"_z{j}": (F.col(f"_b{j}") == F.col(f"_i{j}")).cast("double") for j in range(k)}
    # a clashing row id is kept apart from the models' columns; the row's own bins are constant per row and travel as one array
    pts = base.select(F.col(row_id).alias("_id"), *[c.alias(f) for f, c in vals.items()], F.array(*[c for c in zcols.values()]).alias("_z"),
                      F.array(*[F.col(f"_i{j}") for j in range(k)]).alias("_bins"))
    scored = pts
    for m, one in enumerate(fitted.values()):
        scored = one.transform(scored).withColumnRenamed("prediction", f"_p{m}").drop("features")
    scored = scored.select("_id", "_z", "_bins", F.array(*[F.col(f"_p{m}").cast("double") for m in range(n_models)]).alias("_y"))
    id_type = rows.schema[row_id].dataType
    moments = T.StructType([T.StructField("_id", id_type), T.StructField("_bins", T.ArrayType(T.IntegerType())), T.StructField("_m", T.ArrayType(T.DoubleType()))])

    def products(batches):
        # the weighted products of (1, z, predictions) with themselves, one matrix per explained row and batch
        for pdf in batches:
            z, y = np.stack(pdf["_z"]), np.stack(pdf["_y"])
            w = np.sqrt(np.exp(-((1.0 - z) ** 2).sum(axis=1) / (width * width)))
            x = np.concatenate([np.ones((len(z), 1)), z, y], axis=1)
            group, ids = pd.factorize(pdf["_id"], use_na_sentinel=False)
            first, out = [], []
            for i in range(len(ids)):
                own = np.flatnonzero(group == i)
                first.append(pdf["_bins"].iloc[own[0]])
                out.append((x[own] * w[own, None]).T @ x[own])
            yield pd.DataFrame({"_id": ids, "_bins": first, "_m": [m.reshape(-1) for m in out]})

    parts = scored.mapInPandas(products, moments)
    size = k + 1 + n_models
    schema = T.StructType([T.StructField(row_id, id_type), T.StructField("model", T.StringType()), T.StructField("feature", T.StringType()),
                           T.StructField("condition", T.StringType()), T.StructField("weight", T.DoubleType())])
    model_names = list(fitted)
    names = np.array(feats, dtype=object)
    labels = np.array([[f"{f} <= {e[0]}", f"{e[0]} < {f} <= {e[1]}", f"{e[1]} < {f} <= {e[2]}", f"{f} > {e[2]}"]
                       for f in feats for e in [["%.2f" % x for x in edges[f]]]], dtype=object)

    def ridge(g, h, idx, lam):
        """Ridge solutions (row, 1 + len) on each row's own features ``idx`` (row, feature)."""
        sub = np.concatenate([np.zeros((len(g), 1), int), idx + 1], axis=1)
        gs = np.take_along_axis(np.take_along_axis(g, sub[:, :, None], 1), sub[:, None, :], 2)
        at = np.arange(1, sub.shape[1])
        gs[:, at, at] += lam
        return gs, (np.linalg.pinv(gs) @ np.take_along_axis(h, sub, 1)[:, :, None])[:, :, 0]

    def error(g, h, yy, idx):
        """Weighted squared error of the least squares on the features ``idx``."""
        gs, beta = ridge(g, h, idx, 0.0)
        hs = np.take_along_axis(h, np.concatenate([np.zeros((len(g), 1), int), idx + 1], axis=1), 1)
        return yy - 2 * (beta * hs).sum(1) + np.einsum("ni,nij,nj->n", beta, gs, beta)

    def chosen(g, h, yy):
        """The features (row, num_features) that stay for each row."""
        n = len(g)
        everything = np.broadcast_to(np.arange(k), (n, k))
        if k <= num_features:
            return everything
        if num_features > 6:
            weight = np.abs(ridge(g, h, everything, 0.01)[1][:, 1:])
            return np.sort(np.argsort(-weight, axis=1, kind="stable")[:, :num_features], axis=1)
        used = np.zeros((n, 0), int)
        for _ in range(num_features):
            errors = np.stack([error(g, h, yy, np.concatenate([used, np.full((n, 1), j)], axis=1)) for j in range(k)], axis=1)
            np.put_along_axis(errors, used, np.inf, 1)
            used = np.concatenate([used, errors.argmin(1)[:, None]], axis=1)
        return np.sort(used, axis=1)

    def solve(pdf):
        # the partial matrices of one explained row, at most one per batch of its samples
        total = np.stack(pdf["_m"]).sum(axis=0).reshape(size, size)
        g, out = total[None, :k + 1, :k + 1], []
        for m, name in enumerate(model_names):
            h, yy = total[None, :k + 1, k + 1 + m], total[None, k + 1 + m, k + 1 + m]
            used = chosen(g, h, yy)
            beta = ridge(g, h, used, alpha)[1][:, 1:]
            bins = np.asarray(pdf["_bins"].iloc[0])[used]
            out.append(pd.DataFrame({"model": name, "feature": names[used].reshape(-1), "condition": labels[used, bins].reshape(-1), "weight": beta.reshape(-1)}))
        out = pd.concat(out)
        out[row_id] = pdf["_id"].iloc[0]
        return out[[f.name for f in schema.fields]]

    return parts.groupBy("_id").applyInPandas(solve, schema)
