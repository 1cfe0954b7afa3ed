"""The prepare -> split -> fit -> score -> evaluate flow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidecast.operators._chunks import as_list
from tidecast.operators.fill import forward_fill
from tidecast.operators.index import row_index
from tidecast.operators.joins import enrich
from tidecast.operators.models import (
    evaluate, fit_grouped_linear, fit_predict_linear_window, predict_grouped_linear,
)
from tidecast.operators.profile import drop_missing
from tidecast.operators.split import ordered_split


def prepare(bars: DataFrame, series_wide: DataFrame, cols: Sequence[str], by=("symbol",), on: str = "date",
            fill: str | None = "after", ratio: float = 0.8, chunk=None, materialize: bool = False) -> DataFrame:
    """Join + fill + drop missing + dense index + ordered split flag.

    The index is assigned after the drop, so it has no holes; the split uses
    the per-key count. ``materialize`` writes the result once to the shared
    checkpoint folder (``checkpoint()``): later consumers (fit, score,
    explain) read it instead of re-planning the whole preparation each, and
    the lineage is cut, so a lost executor costs a re-read, not a recompute.
    """
    by = [b for b in as_list(by) if b in bars.columns]
    right = series_wide.select(on, *cols)
    if fill == "after":
        df = enrich(bars, right, on=on, by=by)
        df = forward_fill(df, list(cols), order=on, by=by, chunk=chunk)
    else:
        df = enrich(bars, right, on=on, by=by, fill=fill, chunk=chunk)
    df = drop_missing(df)
    df = row_index(df, on, by=by, chunk=chunk)
    out = ordered_split(df, ratio, order=on, by=by, chunk=chunk)
    if materialize:
        from tidecast.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(out.sparkSession)
        out = out.checkpoint(eager=True)
    return out


def forecast_rmse(prepared: DataFrame, features: Sequence[str], label: str = "close", by=("symbol",),
                  flag: str = "is_train") -> DataFrame:
    """Per-key least squares on the train part, RMSE on the test part.

    With one feature the model is fitted and applied inside the key's window
    (the prepared frame is already partitioned by key, so no shuffle is added);
    otherwise coefficients come from one grouped aggregation and scoring joins
    the small coefficient table back by key. No driver loop over keys.
    """
    by = [b for b in as_list(by) if b in prepared.columns]
    if len(features) == 1 and by:
        # fit and score in the key's window: one pass over the prepared rows
        preds = fit_predict_linear_window(prepared, features[0], label, by, flag).where(f"NOT {flag}")
    else:
        train = prepared.where(flag)
        test = prepared.where(f"NOT {flag}")
        coefs = fit_grouped_linear(train, features, label, by)
        preds = predict_grouped_linear(coefs, test, features, by)
    return evaluate(preds, "rmse", label, by=by)
