"""Readers, bar builders, fixture views and sinks."""

from tidecast.sources.bars import BARS_SCHEMA, from_pandas, make_bars, read_bars, read_ticker_files, read_trades, symbol_filter  # noqa: F401
from tidecast.sources.series import (  # noqa: F401
    BUNDLES, SERIES_SCHEMA, pivot_series, read_series, select_bundle,
)
from tidecast.sources.sinks import load_model, save_model, write_bucketed, write_clustered, write_predictions  # noqa: F401
