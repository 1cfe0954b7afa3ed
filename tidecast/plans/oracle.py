"""DuckDB text of the fixture views, used to write the oracle SQL of each query.

The views mirror tidecast.sources.fixtures; ``with_views(body, *names)``
prefixes a WITH clause holding the named views and their dependencies.
"""

from __future__ import annotations

_BAR_AGGS = ("min_by({p}, {k}) AS open, max({p}) AS high, min({p}) AS low, "
             "max_by({p}, {k}) AS close")

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "bars": ((), f"""SELECT CAST(o_orderdate AS DATE) AS date, {_BAR_AGGS.format(p='o_totalprice', k='o_orderkey')},
        count(*) AS volume FROM orders WHERE isodow(o_orderdate) - 1 < 5 GROUP BY 1"""),
    "bars_multi": ((), f"""SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date,
        {_BAR_AGGS.format(p='o_totalprice', k='o_orderkey')}, count(*) AS volume
        FROM orders WHERE isodow(o_orderdate) - 1 < 5 GROUP BY 1, 2"""),
    "bars_wide": ((), f"""SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS date,
        {_BAR_AGGS.format(p='l_extendedprice', k='row(l_orderkey, l_linenumber, l_partkey, l_extendedprice)')},
        sum(l_quantity) AS volume FROM lineitem GROUP BY 1, 2"""),
    "bars_hourly": ((), f"""SELECT event_type AS symbol, date_trunc('hour', ts) AS ts,
        {_BAR_AGGS.format(p='value', k='event_id')}, count(*) AS volume FROM events GROUP BY 1, 2"""),
    "series": ((), """SELECT CAST(l_shipdate AS DATE) AS date, 'M_MONTHLY' AS series, max(l_extendedprice) AS value
          FROM lineitem WHERE day(l_shipdate) = 1 GROUP BY 1
        UNION ALL SELECT CAST(l_shipdate AS DATE), 'M_WEEKLY', sum(l_quantity) FROM lineitem
          WHERE isodow(l_shipdate) - 1 = 2 GROUP BY 1
        UNION ALL SELECT CAST(l_shipdate AS DATE), 'M_DAILY', sum(l_quantity) FROM lineitem GROUP BY 1"""),
    "series_wide": (("series",), """SELECT date,
        max(value) FILTER (WHERE series = 'M_MONTHLY') AS m_monthly,
        max(value) FILTER (WHERE series = 'M_WEEKLY') AS m_weekly,
        max(value) FILTER (WHERE series = 'M_DAILY') AS m_daily
        FROM series GROUP BY date"""),
    "joined": (("bars", "series_wide"), """SELECT b.*, s.m_monthly, s.m_weekly, s.m_daily
        FROM bars b LEFT JOIN series_wide s ON b.date = s.date"""),
    "joined_multi": (("bars_multi", "series_wide"), """SELECT b.*, s.m_monthly, s.m_weekly, s.m_daily
        FROM bars_multi b LEFT JOIN series_wide s ON b.date = s.date"""),
}


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in VIEWS[n][0]:
            visit(d)
        out.append(n)
    for n in names:
        visit(n)
    return out


def with_views(body: str, *names: str, extra: list[tuple[str, str]] = ()) -> str:
    """``WITH <views...>, <extra...> <body>``."""
    parts = [f"{n} AS ({VIEWS[n][1]})" for n in _closure(names)]
    parts += [f"{n} AS ({sql})" for n, sql in extra]
    return "WITH " + ",\n".join(parts) + "\n" + body
