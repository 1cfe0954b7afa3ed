"""Fixture views built from the test tables (see FIXTURES.md, part B).

Each function reads only the columns it needs from the given parquet tables;
Spark derives everything else, so the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions.columns import lower_columns
from tidecast.sources.bars import make_bars, read_trades
from tidecast.sources.series import pivot_series

# Ids of the three fixture series, upper case as a provider returns them.
SERIES_IDS = ["M_MONTHLY", "M_WEEKLY", "M_DAILY"]
SERIES_COLS = [s.lower() for s in SERIES_IDS]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ticker, weekdays only: (date, open, high, low, close, volume)."""
    o = table(spark, sf_dir, "orders")
    return make_bars(o, ts="o_orderdate", price="o_totalprice", tie="o_orderkey", weekdays_only=True)


def bars_multi(spark: SparkSession, sf_dir: str, symbols=None, start=None, end=None) -> DataFrame:
    """Several tickers: the order priority plays the symbol."""
    o = read_trades(spark, f"{sf_dir}/orders.parquet", "o_orderdate", "o_orderpriority", symbols, start, end)
    return make_bars(o, ts="o_orderdate", price="o_totalprice", tie="o_orderkey",
                     symbol="o_orderpriority", weekdays_only=True)


def bars_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many symbols (supplier keys), volume = summed quantity; the bench table."""
    li = table(spark, sf_dir, "lineitem")
    return make_bars(li, ts="l_shipdate", price="l_extendedprice",
                     tie={"l_orderkey": 44, "l_linenumber": 8, "l_partkey": 36, "l_extendedprice": (27, 2)},
                     symbol="l_suppkey", volume="l_quantity")


def bars_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intraday bars from the events table."""
    ev = table(spark, sf_dir, "events")
    return make_bars(ev, ts="ts", price="value", tie="event_id", symbol="event_type", unit="hour")


def series(spark: SparkSession, sf_dir: str, start=None, end=None) -> DataFrame:
    """Long economic series (date, series, value): monthly, weekly and daily, with ``start <= date < end``.

    One scan and one aggregation of lineitem per date; the three series are
    then the date's aggregates on the days each series is observed.
    """
    li = read_trades(spark, f"{sf_dir}/lineitem.parquet", "l_shipdate", "l_suppkey", None, start, end)
    per_day = li.groupBy(F.col("l_shipdate").cast("date").alias("date")).agg(
        F.max("l_extendedprice").alias("_mx"), F.sum("l_quantity").alias("_q"))
    d = F.col("date")
    wide = per_day.select(
        "date",
        F.when(F.dayofmonth(d) == 1, F.col("_mx")).alias("M_MONTHLY"),
        F.when(F.weekday(d) == 2, F.col("_q")).alias("M_WEEKLY"),
        F.col("_q").alias("M_DAILY"),
        F.dayofmonth(d).alias("_dom"), F.weekday(d).alias("_wd"))
    long = wide.unpivot(["date", "_dom", "_wd"], SERIES_IDS, "series", "value")
    keep = ((F.col("series") == "M_MONTHLY") & (F.col("_dom") == 1)) | \
           ((F.col("series") == "M_WEEKLY") & (F.col("_wd") == 2)) | (F.col("series") == "M_DAILY")
    return long.where(keep).select("date", "series", "value")


def series_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pivoted series with lower-case columns m_monthly, m_weekly, m_daily."""
    return lower_columns(pivot_series(series(spark, sf_dir), SERIES_IDS))


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bars ⟕ series_wide on date."""
    from tidecast.operators.joins import enrich
    return enrich(bars(spark, sf_dir), series_wide(spark, sf_dir), on="date")


def joined_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bars_multi ⟕ series_wide on date (series apply to every symbol)."""
    from tidecast.operators.joins import enrich
    return enrich(bars_multi(spark, sf_dir), series_wide(spark, sf_dir), on="date", by=["symbol"])
