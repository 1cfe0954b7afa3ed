import datetime as dt

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import SF01, rows
from tidecast.operators import joins
from tidecast.sources import fixtures as fx

base = dt.date(2021, 1, 1)
left_s = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 400)), max_size=30,
                  unique=True)
right_s = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 400),
                             st.one_of(st.none(), st.integers(-50, 50).map(float))), max_size=30,
                   unique_by=lambda r: (r[0], r[1]))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(left_s, right_s, st.sampled_from([None, "month", "year"]))
def test_asof_equals_duckdb(spark, left, right, chunk):
    L = [(s, base + dt.timedelta(days=d)) for s, d in left]
    R = [(s, base + dt.timedelta(days=d), v) for s, d, v in right]
    ldf = spark.createDataFrame(L, "symbol string, date date")
    rdf = spark.createDataFrame(R, "symbol string, date date, v double")
    whole = rows(joins.asof_join(ldf, rdf, on="date", by=["symbol"], chunk=chunk, per_column=False),
                 ["symbol", "date", "v"])
    per_col = rows(joins.asof_join(ldf, rdf, on="date", by=["symbol"], chunk=chunk), ["symbol", "date", "v"])
    con = duckdb.connect()
    con.execute("CREATE TABLE l (symbol VARCHAR, date DATE)")
    con.execute("CREATE TABLE r (symbol VARCHAR, date DATE, v DOUBLE)")
    if L:
        con.executemany("INSERT INTO l VALUES (?, ?)", L)
    if R:
        con.executemany("INSERT INTO r VALUES (?, ?, ?)", R)
    want = con.sql("SELECT l.symbol, l.date, r.v FROM l ASOF LEFT JOIN r ON l.symbol = r.symbol "
                   "AND l.date >= r.date").fetchall()
    assert whole == sorted(want)
    want2 = con.sql("SELECT l.symbol, l.date, r.v FROM l ASOF LEFT JOIN (SELECT * FROM r WHERE v IS NOT NULL) r "
                    "ON l.symbol = r.symbol AND l.date >= r.date").fetchall()
    assert per_col == sorted(want2)


def test_fill_semantics_differ_on_fixtures(spark):
    b, s = fx.bars(spark, SF01), fx.series_wide(spark, SF01)
    after = joins.enrich(b, s, fill="after", chunk="year")
    asof = joins.enrich(b, s, fill="asof", chunk="year")
    assert after.exceptAll(asof).count() == 466
    # the monthly series is dated on the 1st, often a weekend: lost by fill-after-join only
    assert after.select("m_monthly").exceptAll(asof.select("m_monthly")).count() == 462


def test_symbol_on_one_side_only(spark):
    ldf = spark.createDataFrame([("a", base), ("z", base)], "symbol string, date date")
    rdf = spark.createDataFrame([("a", base, 1.0)], "symbol string, date date, v double")
    out = {r.symbol: r.v for r in joins.enrich(ldf, rdf, by=["symbol"], fill="asof").collect()}
    assert out == {"a": 1.0, "z": None}
    out2 = {r.symbol: r.v for r in joins.enrich(ldf, rdf, by=["symbol"]).collect()}
    assert out2 == {"a": 1.0, "z": None}


def test_empty_sides(spark):
    ldf = spark.createDataFrame([("a", base), ("a", base + dt.timedelta(days=3))], "symbol string, date date")
    empty_r = spark.createDataFrame([], "symbol string, date date, v double")
    for fill in (None, "after", "before", "asof"):
        out = joins.enrich(ldf, empty_r, by=["symbol"], fill=fill, chunk="month" if fill else None)
        assert sorted((r.date, r.v) for r in out.collect()) == [(base, None), (base + dt.timedelta(days=3), None)]
    empty_l = spark.createDataFrame([], "symbol string, date date")
    rdf = spark.createDataFrame([("a", base, 1.0)], "symbol string, date date, v double")
    assert joins.asof_join(empty_l, rdf, by=["symbol"], chunk="year").count() == 0


def test_right_dates_after_left_give_null(spark):
    ldf = spark.createDataFrame([("a", base)], "symbol string, date date")
    rdf = spark.createDataFrame([("a", base + dt.timedelta(days=1), 1.0)], "symbol string, date date, v double")
    assert joins.asof_join(ldf, rdf, by=["symbol"]).first().v is None
    same = spark.createDataFrame([("a", base, 2.0)], "symbol string, date date, v double")
    assert joins.asof_join(ldf, same, by=["symbol"]).first().v == 2.0


def test_asof_on_timestamps_across_a_dst_gap(spark):
    """Wall-clock timestamps are ordered without the session zone (no collision in a DST gap)."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        t = dt.datetime(2021, 3, 14, 2, 30)  # does not exist in New York
        ldf = spark.createDataFrame([("a", t), ("a", dt.datetime(2021, 3, 14, 3, 10))], "symbol string, ts timestamp_ntz")
        rdf = spark.createDataFrame([("a", dt.datetime(2021, 3, 14, 3, 0), 1.0), ("a", dt.datetime(2021, 3, 14, 2, 0), 0.0)],
                                    "symbol string, ts timestamp_ntz, v double")
        for keyed in (True, False):
            r = rdf if keyed else rdf.drop("symbol")
            out = {x.ts: x.v for x in joins.asof_join(ldf, r, on="ts", by=["symbol"]).collect()}
            assert out == {t: 0.0, dt.datetime(2021, 3, 14, 3, 10): 1.0}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_checked_broadcast(spark):
    from conftest import SF01
    from tidecast.sources import fixtures as fx
    b, s = fx.bars(spark, SF01), fx.series_wide(spark, SF01)
    small = joins.enrich(b, s, broadcast_right=100_000_000)
    assert "BroadcastExchange" in small._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        big = joins.enrich(b, s, broadcast_right=10)  # over the bound: no hint, and AQE may not broadcast
        plan = big._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastExchange" not in plan
        assert rows(big) == rows(small)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
