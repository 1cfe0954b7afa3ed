"""Registered queries over data with NULL keys, NULL times and NaN: each operator's answer there is SQL's.

The input is ``bars_multi`` with one symbol replaced by NULL, one date by NULL, and closing prices that are NaN on
some days and NULL on others.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecast.operators import fill, index, joins, profile, sequences, split
from tidecast.operators.scale import minmax
from tidecast.plans.catalog import register
from tidecast.plans.oracle import with_views
from tidecast.sources import fixtures as fx

_VIEW = ("bn", """SELECT CASE WHEN symbol = '5-LOW' THEN NULL ELSE symbol END AS symbol,
    CASE WHEN date = DATE '1995-03-01' THEN NULL ELSE date END AS date, open,
    CASE WHEN day(date) % 5 = 0 THEN 'NaN'::DOUBLE WHEN day(date) % 7 = 0 THEN NULL ELSE close END AS close, volume
    FROM bars_multi""")


def _sql(body: str, *extra) -> str:
    return with_views(body, "bars_multi", extra=[_VIEW, *extra])


def _dated(body: str, *extra) -> str:
    """The same with dates as text, NULL as 'none', which reads alike from both engines."""
    return _sql(f"SELECT * REPLACE (coalesce(CAST(date AS VARCHAR), 'none') AS date) FROM ({body})", *extra)


def _as_text(df):
    return df.withColumn("date", F.coalesce(F.col("date").cast("string"), F.lit("none")))


def bars_nulls(spark, d):
    b = fx.bars_multi(spark, d)
    day = F.dayofmonth("date")
    return b.select(F.when(F.col("symbol") != "5-LOW", F.col("symbol")).alias("symbol"),
                    F.when(F.col("date") != F.lit("1995-03-01").cast("date"), F.col("date")).alias("date"), "open",
                    F.when(day % 5 == 0, F.lit(float("nan"))).when(day % 7 == 0, F.lit(None)).otherwise(F.col("close")).alias("close"), "volume")


_OVER = "OVER (PARTITION BY symbol ORDER BY date NULLS FIRST"
_CLEAN = "CASE WHEN isnan(close) THEN NULL ELSE close END"


@register("nulls_forward_fill", _dated(
    f"SELECT symbol, date, open, last_value(c IGNORE NULLS) {_OVER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS close, volume "
    f"FROM (SELECT *, {_CLEAN} AS c FROM bn)"))
def q_nulls_forward_fill(spark, d):
    return _as_text(fill.forward_fill(bars_nulls(spark, d), "close", "date", by="symbol", chunk="year"))


@register("nulls_lag_fill", _dated(
    f"SELECT symbol, date, open, coalesce(c, lag(c) {_OVER})) AS close, volume FROM (SELECT *, {_CLEAN} AS c FROM bn)"))
def q_nulls_lag_fill(spark, d):
    return _as_text(fill.lag_fill(bars_nulls(spark, d), "close", "date", by="symbol", chunk="year"))


@register("nulls_row_index", _dated(f"SELECT symbol, date, volume, row_number() {_OVER}) - 1 AS idx FROM bn"))
def q_nulls_row_index(spark, d):
    return _as_text(index.row_index(bars_nulls(spark, d).select("symbol", "date", "volume"), "date", "symbol", chunk="month"))


@register("nulls_ordered_split", _dated(
    f"SELECT symbol, date, volume, row_number() {_OVER}) - 1 AS idx, row_number() {_OVER}) - 1 < "
    "floor(count(*) OVER (PARTITION BY symbol) * 0.8) AS is_train FROM bn"))
def q_nulls_ordered_split(spark, d):
    return _as_text(split.ordered_split(bars_nulls(spark, d).select("symbol", "date", "volume"), 0.8, "date", "symbol", chunk="year"))


@register("nulls_asof_join", _dated(
    "SELECT l.symbol, l.date, l.volume, r.last_open FROM bn l ASOF LEFT JOIN r ON l.symbol = r.symbol AND l.date >= r.date",
    ("r", "SELECT symbol, date, open AS last_open FROM bn WHERE day(date) % 9 = 0 AND symbol IS NOT NULL AND date IS NOT NULL")))
def q_nulls_asof_join(spark, d):
    b = bars_nulls(spark, d)
    # rows of the NULL key and of the NULL time stay in the right side here: they must not match
    right = b.where((F.dayofmonth("date") % 9 == 0) | F.col("date").isNull()).select("symbol", "date", F.col("open").alias("last_open"))
    return _as_text(joins.asof_join(b.select("symbol", "date", "volume"), right, by="symbol", chunk="year"))


@register("asof_join_number", with_views(
    "SELECT l.t, l.volume, r.last_open FROM l ASOF LEFT JOIN r ON l.t >= r.t", "bars", extra=[
        ("l", "SELECT CAST(date_diff('day', DATE '1992-01-01', date) + 0.25 AS DOUBLE) AS t, volume FROM bars"),
        ("r", "SELECT CAST(date_diff('day', DATE '1992-01-01', date) + 0.75 AS DOUBLE) AS t, open AS last_open FROM bars WHERE day(date) % 9 = 0")]))
def q_asof_join_number(spark, d):
    b = fx.bars(spark, d)
    t = F.datediff("date", F.lit("1992-01-01").cast("date")).cast("double")
    right = b.where(F.dayofmonth("date") % 9 == 0).select((t + 0.75).alias("t"), F.col("open").alias("last_open"))
    return joins.asof_join(b.select((t + 0.25).alias("t"), "volume"), right, on="t")


_W, _S, _T = 20, 5, 2


@register("nulls_sequences", _sql(f"""
SELECT st.symbol, st.s AS start, CASE WHEN ro.p - st.s < {_W} THEN 'input' ELSE 'label' END AS part,
       CASE WHEN ro.p - st.s < {_W} THEN ro.p - st.s ELSE ro.p - st.s - {_W} END AS step, ro.volume
FROM starts st JOIN rws ro ON st.symbol IS NOT DISTINCT FROM ro.symbol AND ro.p >= st.s AND ro.p < st.s + {_W + _T}""",
    ("n", f"SELECT symbol, CAST(volume AS DOUBLE) AS volume, row_number() {_OVER}) - 1 AS idx, count(*) OVER (PARTITION BY symbol) AS n FROM bn"),
    ("g", f"SELECT symbol, any_value(n) AS n, ({_W} - any_value(n) % {_W}) % {_W} AS pad FROM n GROUP BY symbol"),
    ("rws", "SELECT n.symbol, n.idx + g.pad AS p, n.volume FROM n JOIN g ON n.symbol IS NOT DISTINCT FROM g.symbol "
            "UNION ALL SELECT symbol, unnest(range(0, pad)) AS p, 0.0 AS volume FROM g"),
    ("starts", f"SELECT symbol, unnest(range(0, n + pad - {_W + _T}, {_S})) AS s FROM g")))
def q_nulls_sequences(spark, d):
    b = bars_nulls(spark, d).select("symbol", "date", F.col("volume").cast("double").alias("volume"))
    s = sequences.build_sequences(b, ["volume"], "date", by="symbol", window=_W, stride=_S, telescope=_T, chunk="year")
    return sequences.sequences_long(s, ["volume"], by="symbol")


@register("nulls_histogram", _sql(
    "SELECT b.symbol, CAST(coalesce(trunc((b.c - s.mn) / nullif((s.mx - s.mn) / 20.0, 0)), 0) AS INTEGER) AS bin, count(*) AS frequency "
    "FROM v b JOIN s ON b.symbol IS NOT DISTINCT FROM s.symbol GROUP BY 1, 2",
    ("v", f"SELECT symbol, c FROM (SELECT symbol, {_CLEAN} AS c FROM bn) WHERE c IS NOT NULL"),
    ("s", "SELECT symbol, min(c) AS mn, max(c) AS mx FROM v GROUP BY symbol")))
def q_nulls_histogram(spark, d):
    return profile.histogram(bars_nulls(spark, d), "close", 20, by="symbol")


@register("nulls_minmax", _dated(
    "SELECT b.symbol, b.date, (b.close - s.mn) / (CASE WHEN s.mx = s.mn THEN 1.0 ELSE s.mx - s.mn END) AS close "
    "FROM bn b JOIN s ON b.symbol IS NOT DISTINCT FROM s.symbol",
    ("s", f"SELECT symbol, min(c) AS mn, max(c) AS mx FROM (SELECT symbol, date, {_CLEAN} AS c FROM bn) WHERE date < DATE '1997-01-01' GROUP BY symbol")))
def q_nulls_minmax(spark, d):
    b = bars_nulls(spark, d).select("symbol", "date", "close")
    return _as_text(minmax(b, "close", F.col("date") < F.lit("1997-01-01").cast("date"), by="symbol"))
