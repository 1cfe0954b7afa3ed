"""Registered queries: one per inventory item, each with its DuckDB oracle text.

Every query reads the given tables through the fixture views, so its work
grows with them. ``QUERIES[name] = (callable(spark, sf_dir) -> DataFrame, sql | None)``;
``None`` marks items that SQL cannot express (models, hashing, streaming):
those are checked by row count and by our own property tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions import calendar as cal
from tidecast.functions.columns import feature_columns, lower_columns, rename, split_xy
from tidecast.operators import fill, index, joins, profile, split
from tidecast.operators.scale import minmax, zscore, zscore_then_minmax
from tidecast.plans.flows import forecast_rmse, prepare
from tidecast.plans.oracle import with_views
from tidecast.sources import fixtures as fx
from tidecast.sources.bars import symbol_filter
from tidecast.sources.sinks import write_bucketed
from tidecast.sources.series import filter_series, pivot_series, select_bundle

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = (fn, sql)
        return fn
    return deco


S = fx.SERIES_COLS  # m_monthly, m_weekly, m_daily
SCOLS = ", ".join(S)


def _ff_sql(col: str, part: str = "", frame: str = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW",
            fn: str = "last_value") -> str:
    p = f"PARTITION BY {part} " if part else ""
    return f"{fn}({col} IGNORE NULLS) OVER ({p}ORDER BY date {frame})"


def _ffill_select(src: str, part: str = "", keep: str = "*") -> str:
    ex = ", ".join(f"{_ff_sql(c, part)} AS {c}" for c in S)
    return f"SELECT {keep} EXCLUDE ({SCOLS}), {ex} FROM {src}"


# ---------------------------------------------------------------------------
# 2.1 scans and sources
# ---------------------------------------------------------------------------

@register("scan_bars", with_views(
    "SELECT * FROM bars_multi WHERE symbol IN ('1-URGENT', '2-HIGH') "
    "AND date >= DATE '1994-01-01' AND date < DATE '1998-01-01'", "bars_multi"))
def q_scan_bars(spark, d):
    # the given trades are scanned with the symbols and the range of dates pushed down
    return fx.bars_multi(spark, d, ["1-URGENT", "2-HIGH"], "1994-01-01", "1998-01-01")


@register("scan_series", with_views(
    "SELECT * FROM series WHERE series IN ('M_MONTHLY', 'M_WEEKLY') "
    "AND date >= DATE '1994-01-01' AND date < DATE '1998-01-01'", "series"))
def q_scan_series(spark, d):
    return filter_series(fx.series(spark, d, "1994-01-01", "1998-01-01"), ["M_MONTHLY", "M_WEEKLY"])


@register("pivot_series", with_views(
    "SELECT date, m_monthly AS M_MONTHLY, m_weekly AS M_WEEKLY, m_daily AS M_DAILY FROM series_wide",
    "series_wide"))
def q_pivot_series(spark, d):
    return pivot_series(fx.series(spark, d), fx.SERIES_IDS)


@register("row_index_even", with_views("SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS idx FROM bars_wide", "bars_wide"))
def q_row_index_even(spark, d):
    """Indexed in buckets of equally many rows that are cut from the data."""
    return index.row_index(fx.bars_wide(spark, d), "date", by="symbol", chunk="even")


@register("forward_fill_even", with_views(_ffill_select("joined_multi", "symbol"), "joined_multi"))
def q_forward_fill_even(spark, d):
    return fill.forward_fill(fx.joined_multi(spark, d), S, "date", by="symbol", chunk="even")


@register("bars_from_ticks", with_views("SELECT * FROM bars_wide", "bars_wide"))
def q_bars_from_ticks(spark, d):
    return fx.bars_wide(spark, d)


@register("symbol_filter", with_views("SELECT * FROM bars_multi WHERE symbol = '3-MEDIUM'", "bars_multi"))
def q_symbol_filter(spark, d):
    return symbol_filter(fx.bars_multi(spark, d), "3-MEDIUM")


@register("indicator_bundle", with_views("SELECT date, m_monthly, m_daily FROM series_wide", "series_wide"))
def q_indicator_bundle(spark, d):
    return select_bundle(fx.series_wide(spark, d), ["M_MONTHLY", "M_DAILY"])


@register("pandas_on_spark", with_views("SELECT * FROM joined_multi", "joined_multi"))
def q_pandas_on_spark(spark, d):
    return fx.joined_multi(spark, d).pandas_api().to_spark()


# ---------------------------------------------------------------------------
# 2.2 projections
# ---------------------------------------------------------------------------

@register("rename_date", with_views("SELECT * EXCLUDE (date), date AS trade_date FROM bars", "bars"))
def q_rename_date(spark, d):
    return rename(fx.bars(spark, d), {"date": "trade_date"})


@register("drop_columns", with_views("SELECT symbol, date, open, close FROM bars_multi", "bars_multi"))
def q_drop_columns(spark, d):
    return fx.bars_multi(spark, d).drop("high", "low", "volume")


@register("drop_date", with_views("SELECT * EXCLUDE (date) FROM joined", "joined"))
def q_drop_date(spark, d):
    return fx.joined(spark, d).drop("date")


@register("select_columns", with_views("SELECT date, close FROM joined", "joined"))
def q_select_columns(spark, d):
    return fx.joined(spark, d).select("date", "close")


@register("lower_columns", with_views("SELECT * FROM series_wide", "series_wide"))
def q_lower_columns(spark, d):
    return lower_columns(pivot_series(fx.series(spark, d), fx.SERIES_IDS))


@register("feature_columns", with_views(
    "SELECT open, high, low, volume, m_monthly, m_weekly, m_daily FROM joined", "joined"))
def q_feature_columns(spark, d):
    j = fx.joined(spark, d)
    return j.select(*feature_columns(j, "close"))


@register("split_xy", with_views(
    "SELECT date, open, high, low, volume, m_monthly, m_weekly, m_daily FROM joined", "joined"))
def q_split_xy(spark, d):
    x, _y = split_xy(fx.joined(spark, d), "close", keys=["date"])
    return x


@register("derived_column", with_views(
    "SELECT *, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, "
    "CAST(day(date) AS INTEGER) AS day, "
    "CAST(year(date) * 10000 + month(date) * 100 + day(date) AS INTEGER) AS fulldate FROM bars", "bars"))
def q_derived_column(spark, d):
    return cal.with_calendar(fx.bars(spark, d))


# ---------------------------------------------------------------------------
# 2.3 filters and missing-data profiling
# ---------------------------------------------------------------------------

_NOT_MISSING = " AND ".join(
    f"{c} IS NOT NULL AND NOT isnan({c})" for c in ["open", "high", "low", "close", *S]) + \
    " AND date IS NOT NULL AND volume IS NOT NULL"


@register("drop_missing", with_views(f"SELECT * FROM joined WHERE {_NOT_MISSING}", "joined"))
def q_drop_missing(spark, d):
    return profile.drop_missing(fx.joined(spark, d))


@register("date_range", with_views(
    "SELECT * FROM bars WHERE date >= DATE '1995-01-01' AND date < DATE '1996-01-01'", "bars"))
def q_date_range(spark, d):
    return profile.between_dates(fx.bars(spark, d), "1995-01-01", "1996-01-01")


@register("count_where_null", with_views(
    "SELECT * FROM (UNPIVOT (SELECT count(*) FILTER (WHERE m_monthly IS NULL) AS m_monthly, "
    "count(*) FILTER (WHERE m_weekly IS NULL) AS m_weekly, count(*) FILTER (WHERE m_daily IS NULL) AS m_daily "
    "FROM joined) ON m_monthly, m_weekly, m_daily INTO NAME \"column\" VALUE n)", "joined"))
def q_count_where_null(spark, d):
    return profile.to_long(profile.null_count(fx.joined(spark, d), S))


def _profile_sql() -> str:
    cols = ["date", "open", "high", "low", "close", "volume", *S]
    fl = {"open", "high", "low", "close", *S}
    ex = ", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c in fl else ''}) AS {c}" for c in cols)
    return with_views(f"SELECT * FROM (UNPIVOT (SELECT {ex} FROM joined) ON {', '.join(cols)} "
                      "INTO NAME \"column\" VALUE n)", "joined")


@register("null_profile", _profile_sql())
def q_null_profile(spark, d):
    return profile.to_long(profile.null_profile(fx.joined(spark, d)))


@register("nan_to_null", with_views("SELECT * FROM joined", "joined"))
def q_nan_to_null(spark, d):
    # gaps arrive as NaN from a pandas-style source: inject them, then turn them back into NULL
    j = fx.joined(spark, d)
    j = j.withColumns({c: F.coalesce(F.col(c), F.lit(float("nan"))) for c in S})
    return fill.sentinel_to_null(j, S)


@register("when_otherwise", with_views(
    "SELECT *, CASE WHEN m_monthly IS NULL THEN close ELSE m_monthly END AS m_monthly_or_close FROM joined",
    "joined"))
def q_when_otherwise(spark, d):
    j = fx.joined(spark, d)
    return j.withColumn("m_monthly_or_close",
                        F.when(F.col("m_monthly").isNull(), F.col("close")).otherwise(F.col("m_monthly")))


# ---------------------------------------------------------------------------
# 2.4 imputation
# ---------------------------------------------------------------------------

@register("forward_fill", with_views(_ffill_select("joined_multi", "symbol"), "joined_multi"))
def q_forward_fill(spark, d):
    return fill.forward_fill(fx.joined_multi(spark, d), S, "date", by="symbol")


@register("forward_fill_chunked", with_views(_ffill_select("joined"), "joined"))
def q_forward_fill_chunked(spark, d):
    return fill.forward_fill(fx.joined(spark, d), S, "date", chunk="year")


def _ffbf_sql() -> str:
    ex = ", ".join(
        f"coalesce({_ff_sql(c, 'symbol')}, "
        f"{_ff_sql(c, 'symbol', 'ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING', 'first_value')}) AS {c}"
        for c in S)
    return with_views(f"SELECT * EXCLUDE ({SCOLS}), {ex} FROM joined_multi", "joined_multi")


@register("ffill_bfill", _ffbf_sql())
def q_ffill_bfill(spark, d):
    return fill.ffill_bfill(fx.joined_multi(spark, d), S, "date", by="symbol", chunk="year")


def _step_sql(src: str, fn: str) -> str:
    ex = ", ".join(
        f"CASE WHEN {c} IS NULL THEN {fn}({c}) OVER (PARTITION BY symbol ORDER BY date) ELSE {c} END AS {c}"
        for c in S)
    return f"SELECT * EXCLUDE ({SCOLS}), {ex} FROM {src}"


@register("lag_fill", with_views(_step_sql("joined_multi", "lag"), "joined_multi"))
def q_lag_fill(spark, d):
    return fill.lag_fill(fx.joined_multi(spark, d), S, "date", by="symbol", chunk="year")


@register("lead_fill", with_views(_step_sql("lagged", "lead"), "joined_multi",
                                  extra=[("lagged", _step_sql("joined_multi", "lag"))]))
def q_lead_fill(spark, d):
    lagged = fill.lag_fill(fx.joined_multi(spark, d), S, "date", by="symbol")
    return fill.lead_fill(lagged, S, "date", by="symbol", chunk="year")


@register("ffill_pandas_api", with_views(_ffill_select("joined_multi", "symbol"), "joined_multi"))
def q_ffill_pandas_api(spark, d):
    return fill.ffill_pandas_api(fx.joined_multi(spark, d), S, "date", by="symbol")


def _fill_default_sql() -> str:
    ex = ", ".join(f"coalesce({_ff_sql(c, 'symbol')}, 0.0) AS {c}" for c in S)
    return with_views(f"SELECT * EXCLUDE ({SCOLS}), {ex} FROM joined_multi", "joined_multi")


@register("fill_default", _fill_default_sql())
def q_fill_default(spark, d):
    return fill.forward_fill(fx.joined_multi(spark, d), S, "date", by="symbol", default=0.0)


# ---------------------------------------------------------------------------
# 2.5 joins
# ---------------------------------------------------------------------------

@register("left_join_date", with_views("SELECT * FROM joined", "joined"))
def q_left_join_date(spark, d):
    return joins.enrich(fx.bars(spark, d), fx.series_wide(spark, d), on="date")


@register("join_then_ffill", with_views(_ffill_select("joined"), "joined"))
def q_join_then_ffill(spark, d):
    return joins.enrich(fx.bars(spark, d), fx.series_wide(spark, d), on="date", fill="after", chunk="year")


@register("ffill_then_join", with_views(
    "SELECT b.*, f.m_monthly, f.m_weekly, f.m_daily FROM bars b LEFT JOIN filled f ON b.date = f.date",
    "bars", "series_wide", extra=[("filled", _ffill_select("series_wide"))]))
def q_ffill_then_join(spark, d):
    return joins.enrich(fx.bars(spark, d), fx.series_wide(spark, d), on="date", fill="before", chunk="year")


@register("asof_join", with_views(
    "SELECT b.*, m.value AS m_monthly, w.value AS m_weekly, y.value AS m_daily FROM bars b "
    "ASOF LEFT JOIN (SELECT date, value FROM series WHERE series = 'M_MONTHLY') m ON b.date >= m.date "
    "ASOF LEFT JOIN (SELECT date, value FROM series WHERE series = 'M_WEEKLY') w ON b.date >= w.date "
    "ASOF LEFT JOIN (SELECT date, value FROM series WHERE series = 'M_DAILY') y ON b.date >= y.date",
    "bars", "series"))
def q_asof_join(spark, d):
    return joins.enrich(fx.bars(spark, d), fx.series_wide(spark, d), on="date", fill="asof", chunk="year")


@register("asof_join_rows", with_views(
    "SELECT b.*, s.m_monthly, s.m_weekly, s.m_daily FROM bars b ASOF LEFT JOIN series_wide s "
    "ON b.date >= s.date", "bars", "series_wide"))
def q_asof_join_rows(spark, d):
    return joins.enrich(fx.bars(spark, d), fx.series_wide(spark, d), on="date", fill="asof", chunk="year",
                        per_column=False)


@register("asof_join_keyed", with_views(
    "SELECT b.*, w.wed_close FROM bars_multi b ASOF LEFT JOIN "
    "(SELECT symbol, date, close AS wed_close FROM bars_multi WHERE isodow(date) - 1 = 2) w "
    "ON b.symbol = w.symbol AND b.date >= w.date", "bars_multi"))
def q_asof_join_keyed(spark, d):
    # right side keyed by symbol: each bar gets its own symbol's latest Wednesday close
    b = fx.bars_multi(spark, d)
    wed = b.where(F.weekday("date") == 2).select("symbol", "date", F.col("close").alias("wed_close"))
    return joins.asof_join(b, wed, on="date", by=["symbol"], chunk="year")


@register("complete_case_join", with_views(
    f"SELECT * FROM joined WHERE {_NOT_MISSING}", "joined"))
def q_complete_case_join(spark, d):
    return joins.complete_case_join(fx.bars(spark, d), fx.series_wide(spark, d), on="date")


# ---------------------------------------------------------------------------
# 2.6 index, sorts, limits, splits
# ---------------------------------------------------------------------------

_IDX = "row_number() OVER (PARTITION BY symbol ORDER BY date) - 1"
_SPLIT_BODY = (f"SELECT *, {_IDX} AS idx, ({_IDX}) < floor(count(*) OVER (PARTITION BY symbol) * 0.8) "
               "AS is_train FROM bars_multi")


def _from_split(body: str, extra=()) -> str:
    return with_views(body, "bars_multi", extra=[("s", _SPLIT_BODY), *extra])


_SPLIT = _from_split("SELECT * FROM s")


def _split_multi(spark, d):
    return split.ordered_split(fx.bars_multi(spark, d), 0.8, "date", by="symbol")


@register("sort_by_date", with_views("SELECT * FROM bars ORDER BY date", "bars"))
def q_sort_by_date(spark, d):
    return fx.bars(spark, d).orderBy("date")


@register("row_index", with_views(f"SELECT *, {_IDX} AS idx FROM bars_multi", "bars_multi"))
def q_row_index(spark, d):
    return index.row_index(fx.bars_multi(spark, d), "date", by="symbol")


@register("row_index_chunked", with_views(
    "SELECT *, row_number() OVER (ORDER BY date) - 1 AS idx FROM bars", "bars"))
def q_row_index_chunked(spark, d):
    return index.row_index(fx.bars(spark, d), "date", chunk="year")


@register("bucketed_prepare", with_views(
    f"SELECT *, {_IDX} AS idx, ({_IDX}) < floor(count(*) OVER (PARTITION BY symbol) * 0.8) AS is_train FROM f", "joined_multi",
    extra=[("f", _ffill_select("joined_multi", "symbol"))]))
def q_bucketed_prepare(spark, d):
    """Bars stored in buckets by symbol: join, fill, index and split without an exchange of them."""
    bars = spark.table(write_bucketed(fx.bars_multi(spark, d), "bars", "symbol", "date", buckets=8))
    df = joins.enrich(bars, fx.series_wide(spark, d), on="date", by="symbol", fill="after").select(*bars.columns, *S)
    return split.ordered_split(index.row_index(df, "date", by="symbol"), 0.8, "date", by="symbol")


@register("ordered_split", _SPLIT)
def q_ordered_split(spark, d):
    return _split_multi(spark, d)


@register("limit_n", with_views("SELECT * FROM bars ORDER BY date LIMIT 100", "bars"))
def q_limit_n(spark, d):
    return split.limit_n(fx.bars(spark, d), 100, "date")


@register("subtract_rows", with_views(
    "SELECT * FROM bars EXCEPT SELECT * FROM bars WHERE date < DATE '1996-01-01'", "bars"))
def q_subtract_rows(spark, d):
    b = fx.bars(spark, d)
    return split.subtract_rows(b, profile.between_dates(b, None, "1996-01-01"))


@register("sort_split", _from_split("SELECT * FROM s WHERE NOT is_train ORDER BY symbol, idx"))
def q_sort_split(spark, d):
    return _split_multi(spark, d).where(~F.col("is_train")).orderBy("symbol", "idx")


@register("random_split", with_views(
    "SELECT *, CASE WHEN CAST('0x' || md5(symbol || '|' || CAST(date AS VARCHAR) || '|42')[1:7] AS BIGINT) < 214748365 "
    "THEN 0 ELSE 1 END AS split FROM bars_multi", "bars_multi"))
def q_random_split(spark, d):
    return split.hash_split(fx.bars_multi(spark, d), ["symbol", "date"], (0.8, 0.2), seed=42)


@register("tail_split", with_views(
    f"SELECT *, {_IDX} AS idx, ({_IDX}) < count(*) OVER (PARTITION BY symbol) - 250 AS is_train "
    "FROM bars_multi", "bars_multi"))
def q_tail_split(spark, d):
    return split.tail_split(fx.bars_multi(spark, d), 250, "date", by="symbol")


@register("test_dates", _from_split("SELECT symbol, date FROM s WHERE NOT is_train"))
def q_test_dates(spark, d):
    return split.test_dates(_split_multi(spark, d), by="symbol")


@register("last_row", with_views(
    "SELECT * FROM bars_multi QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1",
    "bars_multi"))
def q_last_row(spark, d):
    return split.latest(fx.bars_multi(spark, d), "symbol", "date")


@register("first_test_row", _from_split(
    "SELECT * FROM s WHERE NOT is_train QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY idx) = 1"))
def q_first_test_row(spark, d):
    return split.first_row(_split_multi(spark, d).where(~F.col("is_train")), "symbol", "idx")


# ---------------------------------------------------------------------------
# 2.7 aggregations
# ---------------------------------------------------------------------------

@register("count_rows", with_views("SELECT count(*) AS n FROM joined", "joined"))
def q_count_rows(spark, d):
    return profile.count_rows(fx.joined(spark, d))


@register("summary_stats", with_views(
    "SELECT round(min(close), 4) AS min_close, round(max(close), 4) AS max_close, "
    "round(avg(close), 4) AS mean_close, round(stddev_samp(close), 4) AS stddev_close FROM joined", "joined"))
def q_summary_stats(spark, d):
    s = profile.summary(fx.joined(spark, d), "close")
    return s.select(*[F.round(c, 4).alias(c) for c in s.columns])


_HIST = ("SELECT CAST(trunc((close - m.mn) / ((m.mx - m.mn) / 20.0)) AS INTEGER) AS bin, "
         "count(*) AS frequency{edge} FROM joined, (SELECT min(close) AS mn, max(close) AS mx FROM joined) m "
         "GROUP BY 1{g}")


@register("histogram", with_views(_HIST.format(edge="", g=""), "joined"))
def q_histogram(spark, d):
    return profile.histogram(fx.joined(spark, d), "close", 20)


@register("histogram_edges", with_views(_HIST.format(
    edge=", round(any_value(CAST(trunc((close - m.mn) / ((m.mx - m.mn) / 20.0)) AS INTEGER) "
         "* ((m.mx - m.mn) / 20.0) + m.mn), 4) AS edge", g=""), "joined"))
def q_histogram_edges(spark, d):
    h = profile.histogram(fx.joined(spark, d), "close", 20, edges=True)
    return h.withColumn("edge", F.round("edge", 4))


@register("partition_count", "SELECT CAST(7 AS BIGINT) AS partitions")
def q_partition_count(spark, d):
    # counted by the rows in them
    return index.partition_sizes(fx.bars_wide(spark, d).repartition(7)).agg(F.count("*").alias("partitions"))


@register("partition_rows", with_views(
    "SELECT CAST(7 AS BIGINT) AS partitions, CAST(0 AS BIGINT) AS empty, count(*) AS n_rows FROM bars_wide", "bars_wide"))
def q_partition_rows(spark, d):
    return index.partition_rows(fx.bars_wide(spark, d).repartition(7))


@register("count_by_split", _from_split("SELECT symbol, is_train, count(*) AS n FROM s GROUP BY 1, 2"))
def q_count_by_split(spark, d):
    return profile.count_by_split(_split_multi(spark, d), by="symbol")


def _scaled_sql(kind: str, cols: list[str]) -> str:
    """DuckDB text of min-max / z-score fitted on the train part, per symbol."""
    def mm(c, src_alias="t"):
        return (f"({c} - {src_alias}.mn_{c}) / CASE WHEN {src_alias}.mx_{c} - {src_alias}.mn_{c} = 0 THEN 1.0 "
                f"ELSE {src_alias}.mx_{c} - {src_alias}.mn_{c} END")
    stats_mm = ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in cols)
    stats_z = ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in cols)
    z = ", ".join(f"({c} - t.mu_{c}) / CASE WHEN t.sd_{c} = 0 THEN 1.0 ELSE t.sd_{c} END AS {c}" for c in cols)
    keep = "s.symbol, s.date, s.idx, s.is_train"
    if kind == "minmax":
        body = (f"SELECT {keep}, {', '.join(mm(c) + ' AS ' + c for c in cols)} FROM s JOIN "
                f"(SELECT symbol, {stats_mm} FROM s WHERE is_train GROUP BY symbol) t ON s.symbol = t.symbol")
        return body
    zsql = (f"SELECT {keep}, {z} FROM s JOIN (SELECT symbol, {stats_z} FROM s WHERE is_train GROUP BY symbol) t "
            "ON s.symbol = t.symbol")
    if kind == "zscore":
        return zsql
    return (f"SELECT z.symbol, z.date, z.idx, z.is_train, {', '.join(mm(c) + ' AS ' + c for c in cols)} "
            f"FROM ({zsql}) z JOIN (SELECT symbol, {stats_mm} FROM ({zsql}) WHERE is_train GROUP BY symbol) t "
            "ON z.symbol = t.symbol")


SCALE_COLS = ["open", "close", "volume"]


def _scaled(spark, d, fn):
    s = _split_multi(spark, d).select("symbol", "date", "idx", "is_train", *SCALE_COLS)
    s = s.withColumn("volume", F.col("volume").cast("double"))
    return fn(s, SCALE_COLS, fit_on="is_train", by="symbol")


def _round_cols(df: DataFrame, cols, n: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c in cols})


def _rounded_sql(inner: str, cols, n: int = 6) -> str:
    other = "symbol, date, idx, is_train"
    return f"SELECT {other}, {', '.join(f'round({c}, {n}) AS {c}' for c in cols)} FROM ({inner})"


def _scaled_from(body: str) -> str:
    return with_views(body, "bars_multi", extra=[
        ("s0", _SPLIT_BODY),
        ("s", "SELECT symbol, date, idx, is_train, open, close, CAST(volume AS DOUBLE) AS volume FROM s0")])


@register("min_max_check", _scaled_from("SELECT symbol, " + ", ".join(
    f"round(min({c}), 6) AS min_{c}, round(max({c}), 6) AS max_{c}" for c in SCALE_COLS) +
    f" FROM ({_scaled_sql('minmax', SCALE_COLS)}) GROUP BY symbol"))
def q_min_max_check(spark, d):
    m = profile.min_max(_scaled(spark, d, minmax), SCALE_COLS, by="symbol")
    return _round_cols(m, [c for c in m.columns if c != "symbol"])


# ---------------------------------------------------------------------------
# 2.8 windows
# ---------------------------------------------------------------------------

@register("last_non_null", with_views(
    f"SELECT *, {_ff_sql('m_weekly', 'symbol')} AS m_weekly_last FROM joined_multi", "joined_multi"))
def q_last_non_null(spark, d):
    j = fx.joined_multi(spark, d)
    return j.withColumn("m_weekly_last", fill.last_non_null("m_weekly", "date", "symbol"))


@register("lag_value", with_views(
    "SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS prev_close FROM bars_multi", "bars_multi"))
def q_lag_value(spark, d):
    return fx.bars_multi(spark, d).withColumn("prev_close", fill.lag_value("close", "date", "symbol"))


@register("lead_value", with_views(
    "SELECT *, lead(close) OVER (PARTITION BY symbol ORDER BY date) AS next_close FROM bars_multi", "bars_multi"))
def q_lead_value(spark, d):
    return fx.bars_multi(spark, d).withColumn("next_close", fill.lead_value("close", "date", "symbol"))


@register("lag_difference", with_views(
    "SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) - close AS close_lag_diff FROM bars_multi",
    "bars_multi"))
def q_lag_difference(spark, d):
    return fill.lag_diff(fx.bars_multi(spark, d), "close", "date", "symbol", chunk="year")


# ---------------------------------------------------------------------------
# 2.9 scalar functions
# ---------------------------------------------------------------------------

@register("date_parts", with_views(
    "SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, "
    "CAST(day(date) AS INTEGER) AS day FROM bars", "bars"))
def q_date_parts(spark, d):
    return fx.bars(spark, d).select("date", *[c.alias(n) for n, c in cal.date_parts("date").items()])


@register("day_of_week", with_views(
    "SELECT date, CAST(isodow(date) - 1 AS INTEGER) AS weekday FROM bars_wide", "bars_wide"))
def q_day_of_week(spark, d):
    return fx.bars_wide(spark, d).select("date", cal.day_of_week("date").alias("weekday"))


@register("hour", with_views(
    "SELECT symbol, ts, CAST(hour(ts) AS INTEGER) AS hour FROM bars_hourly", "bars_hourly"))
def q_hour(spark, d):
    return fx.bars_hourly(spark, d).select("symbol", "ts", cal.hour_of("ts").alias("hour"))


@register("fulldate", with_views(
    "SELECT date, CAST(CAST(year(date) AS VARCHAR) || lpad(CAST(month(date) AS VARCHAR), 2, '0') || "
    "lpad(CAST(day(date) AS VARCHAR), 2, '0') AS INTEGER) AS fulldate FROM bars", "bars"))
def q_fulldate(spark, d):
    return fx.bars(spark, d).select("date", cal.fulldate("date").alias("fulldate"))


@register("parse_date", with_views(
    "SELECT strftime(date, '%Y-%m-%d') AS date_text, CAST(strptime(strftime(date, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) "
    "AS parsed FROM bars", "bars"))
def q_parse_date(spark, d):
    b = fx.bars(spark, d).select(F.date_format("date", "yyyy-MM-dd").alias("date_text"))
    return b.select("date_text", cal.parse_date("date_text").alias("parsed"))


@register("cast_int", with_views(
    "SELECT date, CAST(trunc(close / 1000.0) AS INTEGER) AS close_k FROM bars", "bars"))
def q_cast_int(spark, d):
    return fx.bars(spark, d).select("date", (F.col("close") / 1000.0).cast("int").alias("close_k"))


@register("is_nan_is_null", with_views(
    "SELECT date, m_monthly IS NULL AS monthly_is_null, isnan(coalesce(m_monthly, 'NaN'::DOUBLE)) AS monthly_is_nan "
    "FROM joined", "joined"))
def q_is_nan_is_null(spark, d):
    j = fx.joined(spark, d)
    return j.select("date", F.col("m_monthly").isNull().alias("monthly_is_null"),
                    F.isnan(F.coalesce("m_monthly", F.lit(float("nan")))).alias("monthly_is_nan"))


@register("is_null", with_views(
    "SELECT date, m_monthly IS NULL AS monthly_is_null, m_weekly IS NULL AS weekly_is_null FROM joined", "joined"))
def q_is_null(spark, d):
    j = fx.joined(spark, d)
    return j.select("date", F.col("m_monthly").isNull().alias("monthly_is_null"),
                    F.col("m_weekly").isNull().alias("weekly_is_null"))


@register("is_nan", with_views(
    "SELECT date, isnan(coalesce(m_monthly, 'NaN'::DOUBLE)) AS monthly_is_nan, isnan(close) AS close_is_nan "
    "FROM joined", "joined"))
def q_is_nan(spark, d):
    # gaps arrive as NaN from a pandas-style source; isnan is only defined on float/double columns
    j = fx.joined(spark, d)
    return j.select("date", F.isnan(F.coalesce("m_monthly", F.lit(float("nan")))).alias("monthly_is_nan"),
                    F.isnan("close").alias("close_is_nan"))


@register("literal", with_views(
    "SELECT date, CAST(1.0 AS DOUBLE) AS one, CAST(NULL AS DOUBLE) AS missing FROM bars", "bars"))
def q_literal(spark, d):
    return fx.bars(spark, d).select("date", F.lit(1.0).alias("one"), F.lit(None).cast("double").alias("missing"))


@register("coalesce", with_views(
    "SELECT date, coalesce(m_monthly, m_weekly, m_daily) AS first_series FROM joined", "joined"))
def q_coalesce(spark, d):
    return fx.joined(spark, d).select("date", F.coalesce(*S).alias("first_series"))


@register("column_arith", with_views(
    "SELECT date, round(CASE WHEN high - low = 0 THEN NULL ELSE (close - open) / (high - low) END, 6) AS body "
    "FROM bars", "bars"))
def q_column_arith(spark, d):
    b = fx.bars(spark, d)
    body = F.try_divide(F.col("close") - F.col("open"), F.col("high") - F.col("low"))
    return b.select("date", F.round(body, 6).alias("body"))


@register("date_sequence", with_views(
    "SELECT symbol, CAST(unnest(generate_series(date, date + INTERVAL 10 DAY, INTERVAL 1 DAY)) AS DATE) AS date "
    "FROM (SELECT symbol, max(date) AS date FROM bars_multi GROUP BY symbol)", "bars_multi"))
def q_date_sequence(spark, d):
    last = fx.bars_multi(spark, d).groupBy("symbol").agg(F.max("date").alias("date"))
    return last.select("symbol", F.explode(cal.date_sequence("date", 10)).alias("date"))


# ---------------------------------------------------------------------------
# flagship: prepare -> split -> per-symbol least squares -> RMSE
# ---------------------------------------------------------------------------

FLAGSHIP_SQL = with_views("""
SELECT symbol, round(sqrt(avg(power(close - (c.a + c.b * open), 2))), 3) AS rmse
FROM s JOIN c USING (symbol) WHERE NOT is_train GROUP BY symbol""", "bars_multi", "series_wide", extra=[
    ("j", "SELECT b.symbol, b.date, b.open, b.close, w.m_monthly FROM bars_multi b "
          "LEFT JOIN series_wide w ON b.date = w.date"),
    ("f", f"SELECT symbol, date, open, close, {_ff_sql('m_monthly', 'symbol')} AS m_monthly FROM j"),
    ("dd", "SELECT * FROM f WHERE open IS NOT NULL AND NOT isnan(open) AND close IS NOT NULL AND NOT isnan(close) "
           "AND m_monthly IS NOT NULL AND NOT isnan(m_monthly)"),
    ("s", f"SELECT *, ({_IDX}) < floor(count(*) OVER (PARTITION BY symbol) * 0.8) AS is_train FROM dd"),
    ("c", "SELECT symbol, regr_slope(close, open) AS b, regr_intercept(close, open) AS a FROM s "
          "WHERE is_train GROUP BY symbol"),
])


def flagship(spark: SparkSession, d: str) -> DataFrame:
    bars = fx.bars_multi(spark, d).select("symbol", "date", "open", "close")
    prepared = prepare(bars, fx.series_wide(spark, d), ["m_monthly"], by="symbol", ratio=0.8)
    r = forecast_rmse(prepared, ["open"], "close", by="symbol")
    return r.select("symbol", F.round("rmse", 3).alias("rmse"))


register("forecast_rmse", FLAGSHIP_SQL)(flagship)


# ---------------------------------------------------------------------------
# 2.10 scaling fitted on the train part (V2-V4), on the split fixture
# ---------------------------------------------------------------------------

@register("minmax_train", _scaled_from(_rounded_sql(_scaled_sql("minmax", SCALE_COLS), SCALE_COLS)))
def q_minmax_train(spark, d):
    return _round_cols(_scaled(spark, d, minmax), SCALE_COLS)


@register("zscore_train", _scaled_from(_rounded_sql(_scaled_sql("zscore", SCALE_COLS), SCALE_COLS)))
def q_zscore_train(spark, d):
    return _round_cols(_scaled(spark, d, zscore), SCALE_COLS)


@register("zscore_then_minmax", _scaled_from(_rounded_sql(_scaled_sql("both", SCALE_COLS), SCALE_COLS)))
def q_zscore_then_minmax(spark, d):
    return _round_cols(_scaled(spark, d, zscore_then_minmax), SCALE_COLS)
