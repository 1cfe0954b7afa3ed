"""Scaling fitted on the train part and applied to all rows (V2-V4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.operators._chunks import as_list, join_on_keys, one_row


def _fit_apply(df: DataFrame, cols, fit_on, by, stat_aggs, transform) -> DataFrame:
    by = as_list(by)
    cols = as_list(cols)
    fit = df.where(F.col(fit_on)) if isinstance(fit_on, str) else (df.where(fit_on) if fit_on is not None else df)
    aggs = [a for c in cols for a in stat_aggs(c)]
    if by:
        stats = fit.groupBy(*by).agg(*aggs)
        out = join_on_keys(df, stats, by)
        ref = lambda name: F.col(name)
    else:
        # a single row of statistics: scalar subqueries, no join at all
        stats = one_row(fit.agg(*aggs))
        out = df
        ref = lambda name: stats[name]
    out = out.withColumns({c: transform(c, ref) for c in cols})
    return out.select(*df.columns)


def _valid(c):
    """The column without NaN, which would spoil its statistics; a NaN row itself stays NaN."""
    return F.when(~F.isnan(c), F.col(c))


def minmax(df: DataFrame, cols, fit_on="is_train", by=()) -> DataFrame:
    """``(x - min) / (max - min)`` with train min/max (V2); test rows may leave [0, 1].

    A constant column has range 0 and is divided by 1 instead, so train rows
    map to 0 (the common scaler convention; MLlib's MinMaxScaler would give 0.5).
    """
    def aggs(c):
        return [F.min(_valid(c)).alias(f"_mn_{c}"), F.max(_valid(c)).alias(f"_mx_{c}")]

    def tr(c, ref):
        rng = ref(f"_mx_{c}") - ref(f"_mn_{c}")
        return (F.col(c) - ref(f"_mn_{c}")) / F.when(rng == 0, F.lit(1.0)).otherwise(rng)
    return _fit_apply(df, cols, fit_on, by, aggs, tr)


def zscore(df: DataFrame, cols, fit_on="is_train", by=()) -> DataFrame:
    """``(x - mean) / std`` with train mean and population std (V3); std 0 → 1."""
    def aggs(c):
        return [F.avg(_valid(c)).alias(f"_mu_{c}"), F.stddev_pop(_valid(c)).alias(f"_sd_{c}")]

    def tr(c, ref):
        sd = ref(f"_sd_{c}")
        return (F.col(c) - ref(f"_mu_{c}")) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)
    return _fit_apply(df, cols, fit_on, by, aggs, tr)


def zscore_then_minmax(df: DataFrame, cols, fit_on="is_train", by=()) -> DataFrame:
    """Standardise, then min-max (V4); equal to min-max alone up to rounding."""
    return minmax(zscore(df, cols, fit_on, by), cols, fit_on, by)


def inverse_minmax(df: DataFrame, cols, source: DataFrame, like: str | None = None, fit_on="is_train", by=()) -> DataFrame:
    """Columns scaled by :func:`minmax` back in their units: ``x * (max - min) + min`` with the train min and max of
    ``source``, the unscaled table. ``like`` names the one column of ``source`` that all ``cols`` are scaled by (for
    example a prediction of it); without it each column is scaled by itself."""
    by, cols = as_list(by), as_list(cols)
    fit = source.where(F.col(fit_on)) if isinstance(fit_on, str) else (source.where(fit_on) if fit_on is not None else source)
    names = [like or c for c in cols]
    aggs = [x for n in dict.fromkeys(names) for x in (F.min(_valid(n)).alias(f"_mn_{n}"), F.max(_valid(n)).alias(f"_mx_{n}"))]
    if by:
        out, ref = join_on_keys(df, fit.groupBy(*by).agg(*aggs), by), F.col
    else:
        row = one_row(fit.agg(*aggs))
        out, ref = df, lambda name: row[name]
    rng = lambda n: ref(f"_mx_{n}") - ref(f"_mn_{n}")
    out = out.withColumns({c: F.col(c) * F.when(rng(n) == 0, F.lit(1.0)).otherwise(rng(n)) + ref(f"_mn_{n}") for c, n in zip(cols, names)})
    return out.select(*df.columns)
