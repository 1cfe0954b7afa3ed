import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from conftest import SF01, rows
from tidecast.sources import fixtures as fx
from tidecast.sources.bars import from_pandas, make_bars, read_bars, read_ticker_files
from tidecast.sources.series import BUNDLES, pivot_series, read_series, select_bundle
from tidecast.sources.sinks import write_predictions


def test_from_pandas_resets_index(spark):
    idx = pd.DatetimeIndex([dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2)])
    pdf = pd.DataFrame({"close": [1.0, float("nan")]}, index=idx)
    df = from_pandas(spark, pdf, "date timestamp, close double")
    assert df.columns == ["date", "close"]
    # NaN arrives as NULL with Arrow transfer on, as NaN with it off; both count as missing
    assert df.where(F.isnan("close") | F.col("close").isNull()).count() == 1


def test_read_bars_prunes_and_filters(spark, tmp_path):
    path = str(tmp_path / "bars")
    fx.bars_multi(spark, SF01).write.partitionBy("symbol").parquet(path)
    df = read_bars(spark, path, ["2-HIGH"], "1995-01-01", "1995-02-01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan or "PartitionFilters: [symbol" in plan
    got = df.collect()
    assert got and all(r.symbol == "2-HIGH" and dt.date(1995, 1, 1) <= r.date < dt.date(1995, 2, 1) for r in got)


def test_read_series_and_pivot_roundtrip(spark, tmp_path):
    path = str(tmp_path / "series")
    fx.series(spark, SF01).write.parquet(path)
    s = read_series(spark, path, ["M_DAILY"])
    assert s.select("series").distinct().count() == 1
    wide = pivot_series(read_series(spark, path), fx.SERIES_IDS)
    assert set(wide.columns) == {"date", *fx.SERIES_IDS}


def test_bundles_are_the_reference_lists(spark):
    assert len(BUNDLES["market"]) == 14 and len(BUNDLES["macro"]) == 20
    df = spark.createDataFrame([(dt.date(2020, 1, 1), 1.0, 2.0, 3.0)], "DATE date, sp500 double, DGS10 double, x double")
    assert select_bundle(df, "market", keep=["date"]).columns == ["DATE", "sp500", "DGS10"]


def test_make_bars_open_close_by_tie(spark):
    ticks = spark.createDataFrame([
        ("a", dt.datetime(2020, 1, 1, 9), 10.0, 3), ("a", dt.datetime(2020, 1, 1, 10), 12.0, 1),
        ("a", dt.datetime(2020, 1, 1, 11), 8.0, 2), ("a", dt.datetime(2020, 1, 2, 9), 5.0, 7)],
        "sym string, ts timestamp_ntz, px double, id int")
    b = {r.date: r for r in make_bars(ticks, "ts", "px", "id", symbol="sym").collect()}
    d1 = b[dt.date(2020, 1, 1)]
    assert (d1.open, d1.high, d1.low, d1.close, d1.volume) == (12.0, 12.0, 8.0, 10.0, 3)
    h = make_bars(ticks, "ts", "px", "id", symbol="sym", unit="hour")
    assert h.count() == 4 and dict(h.dtypes)["ts"] == "timestamp_ntz"


def test_write_predictions_layout(spark, tmp_path):
    df = fx.bars_multi(spark, SF01).select("symbol", "date", F.col("close").alias("prediction"))
    path = write_predictions(df, str(tmp_path / "p"))
    back = spark.read.parquet(path)
    assert rows(back.select("symbol", "date", "prediction")) == rows(df)
    plan = back.where("symbol = '2-HIGH'")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(symbol), EqualTo(symbol,2-HIGH)]" in plan


def test_packed_tie_key_orders_like_the_columns_and_raises_beyond_its_widths(spark):
    import random

    import pytest
    from tidecast.sources.bars import pack_key
    rng = random.Random(4)
    data = [(rng.choice([None, 0, 3, 2**40 - 2]), rng.choice([None, 0, 1, 6]), rng.choice([None, 0.0, 0.07, 12.35, 83000.01]), i) for i in range(400)]
    df = spark.createDataFrame(data, "a long, b int, p double, i long")
    for parts in ({"a": 41, "b": 4, "p": (24, 2)}, {"b": 3, "p": (30, 2)}):
        cols = list(parts)
        got = [tuple(r) for r in df.select(*cols, pack_key(parts).alias("k")).collect()]
        low = lambda r: tuple((x is not None, x or 0) for x in r[:-1])
        assert [low(r) for r in sorted(got, key=lambda r: r[-1])] == sorted(map(low, got))
        assert len({r[-1] for r in got}) == len(set(map(low, got)))
    for row, parts in (((2**40, 1, 1.0), {"a": 40}), ((-1, 1, 1.0), {"a": 40}), ((1, 7, 1.0), {"b": 3}), ((1, 1, 1.005), {"p": (30, 2)})):
        bad = spark.createDataFrame([row], "a long, b int, p double")
        with pytest.raises(Exception, match="don't fit"):
            bad.select(pack_key(parts)).collect()
    with pytest.raises(ValueError):
        pack_key({"a": 60, "b": 60, "c": 8})


def test_bars_with_a_packed_tie_hash_and_equal_those_with_a_struct(spark):
    df = fx.table(spark, SF01, "lineitem")
    args = dict(ts="l_shipdate", price="l_extendedprice", symbol="l_suppkey", volume="l_quantity")
    plain = make_bars(df, tie=["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"], **args)
    packed = fx.bars_wide(spark, SF01)
    assert rows(plain) == rows(packed)
    assert "SortAggregate" not in packed._jdf.queryExecution().executedPlan().toString()


def test_scans_of_given_files_push_symbols_and_dates(spark):
    from tidecast.plans.registry import all_queries
    for name, pushed in (("scan_bars", ("o_orderpriority", "o_orderdate")), ("scan_series", ("l_shipdate",))):
        df = all_queries()[name][0](spark, SF01)
        plan = df._jdf.queryExecution().executedPlan().toString()
        filters = plan[plan.index("PushedFilters"):plan.index("ReadSchema")]
        assert all(f"({c}," in filters for c in pushed), filters
        assert plan.count("FileScan") == 1 and "o_comment" not in plan and "l_partkey" not in plan


def test_ticker_files_only_those_asked_for_are_read(spark, tmp_path):
    import pytest
    for t in ("AAPL", "BRK-B", "A&B C"):
        (tmp_path / f"{t}.csv").write_text("date,open,high,low,close,adjclose,volume\n2020-01-02,1,2,0.5,1.5,1.4,100\n2020-02-03,2,3,1.5,2.5,2.4,\n")
    (tmp_path / "BROKEN.csv").write_text("not,bars\nx,y\n")
    df = read_ticker_files(spark, str(tmp_path), ["AAPL", "A&B C"], start="2020-02-01")
    assert rows(df.select("symbol", "date", "close", "volume")) == [("A&B C", dt.date(2020, 2, 3), 2.5, None), ("AAPL", dt.date(2020, 2, 3), 2.5, None)]
    assert sorted(f.rsplit("/", 1)[-1] for f in df.inputFiles()) == ["A&B%20C.csv", "AAPL.csv"] or len(df.inputFiles()) == 2
    assert rows(df.select("symbol", "close")) == [("A&B C", 2.5), ("AAPL", 2.5)]
    with pytest.raises(Exception, match="(?i)exist|not found"):
        read_ticker_files(spark, str(tmp_path), ["NONE"]).collect()
