"""Future dates, scoring them, and the actual-vs-predicted table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.functions import calendar as cal
from tidecast.operators._chunks import as_list, join_on_keys, one_row
from tidecast.operators.split import latest

CALENDAR = ("year", "month", "day", "fulldate")


def future_frame(df: DataFrame, n: int = 10, by=(), date_col: str = "date", include_last: bool = True) -> DataFrame:
    """The last date of each key and the next ``n`` days (n + 1 rows with the last).

    Output: by..., step (0 = last known date), date, year, month, day, fulldate.
    """
    by = as_list(by)
    last = df.groupBy(*by).agg(F.max(date_col).alias("_d")) if by else df.agg(F.max(date_col).alias("_d"))
    first = 0 if include_last else 1
    out = last.select(*by, "_d", F.explode(F.sequence(F.lit(first), F.lit(n))).alias("step"))
    out = out.select(*by, F.col("step").cast("long").alias("step"), F.date_add("_d", F.col("step").cast("int")).alias(date_col))
    return cal.with_calendar(out, date_col)


def carry_forward(df: DataFrame, n: int = 10, by=(), date_col: str = "date", idx: str | None = "idx",
                  calendar: Sequence[str] = CALENDAR) -> DataFrame:
    """Future rows with the last known non-calendar values carried forward (T2's input).

    Calendar columns are recomputed for each future date; ``idx`` continues
    from the last known index.
    """
    by = as_list(by)
    has_idx = bool(idx) and idx in df.columns
    last = latest(df, by, date_col)
    fut = future_frame(df, n, by, date_col)
    keep = [c for c in df.columns if c not in {*by, date_col, *calendar} and c != idx]
    carried = last.select(*by, *keep, *([F.col(idx).alias("_last_idx")] if has_idx else []))
    if by:
        out = join_on_keys(fut, carried, by)
    else:
        row = one_row(carried)
        out = fut.withColumns({c: row[c] for c in carried.columns})
    if has_idx:
        out = out.withColumn(idx, F.col("_last_idx") + F.col("step")).drop("_last_idx")
    cal_cols = [c for c in calendar if c in df.columns]
    return out.select(*by, "step", date_col, *cal_cols, *keep, *([idx] if has_idx else []))


def forecast_table(history: DataFrame, preds: DataFrame, by=(), idx: str = "idx", label: str = "close",
                   date_col: str = "date") -> DataFrame:
    """History ⟕ predictions on (key, idx): index, date, actual, predicted."""
    by = as_list(by)
    p = preds.select(*by, idx, "prediction")
    return join_on_keys(history.select(*by, idx, date_col, label), p, [*by, idx])


def fit_horizons(seqs: DataFrame, label_col: int = 0, horizons: int | None = None, kind: str = "lr",
                 by=(), anchor: str = "start", fit_on=None, parallelism: int = 4, **params):
    """Multi-step forecast from sequences: one regressor per step ahead.

    ``seqs`` comes from ``build_sequences`` (``inputs``: window x features,
    ``labels``: telescope x features). The window is flattened into one
    feature vector; the target of horizon h is feature ``label_col`` of label
    row h. Returns (models by horizon, predictions: by..., anchor, horizon,
    label, prediction). Not a recurrent network: a regressor per horizon.

    ``fit_on`` (a condition on ``seqs``) gives the windows to learn from; the
    others, and only they, are scored. Without it all windows are fitted and
    scored. The windows are written once to the shared checkpoint folder and
    the horizons are fitted ``parallelism`` at a time from there.
    """
    from multiprocessing.pool import ThreadPool

    from pyspark.ml.functions import array_to_vector
    from tidecast.operators.models import model_choice
    from tidecast.session import ensure_checkpoint_dir

    by = as_list(by)
    n_h = horizons or len(seqs.select("labels").first()["labels"])
    data = seqs.select(*by, anchor, array_to_vector(F.flatten("inputs")).alias("features"),
                       (F.lit(True) if fit_on is None else F.coalesce(fit_on, F.lit(False))).alias("_fit"),
                       *[F.col("labels")[h][label_col].alias(f"_y{h + 1}") for h in range(n_h)])
    ensure_checkpoint_dir(seqs.sparkSession)
    data = data.checkpoint(eager=True)

    def one(h):
        est = model_choice(kind, featuresCol="features", labelCol=f"_y{h}", **params)
        return est.fit(data.where(F.col("_fit") & F.col(f"_y{h}").isNotNull()))

    with ThreadPool(parallelism) as pool:
        fitted = dict(zip(range(1, n_h + 1), pool.map(one, range(1, n_h + 1), chunksize=1)))
    scored, preds = data if fit_on is None else data.where("NOT _fit"), None
    for h, m in fitted.items():
        p = m.transform(scored).select(*by, anchor, F.lit(h).alias("horizon"), F.col(f"_y{h}").alias("label"),
                                     "prediction")
        preds = p if preds is None else preds.unionByName(p)
    return fitted, preds
