"""Calendar features (X1-X5, X11). All are JVM expressions, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_parts(c: str | Column) -> dict[str, Column]:
    """year, month, day of month as int columns."""
    c = _c(c)
    return {"year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c)}


def day_of_week(c: str | Column) -> Column:
    """Monday = 0 .. Sunday = 6 (X2). ``dayofweek`` would give Sunday = 1."""
    return F.weekday(_c(c))


def hour_of(c: str | Column) -> Column:
    """Hour of a timestamp."""
    return F.hour(_c(c))


def fulldate(c: str | Column) -> Column:
    """``yyyymmdd`` as int.

    Equal to casting concat(year, lpad(month, 2, '0'), lpad(day, 2, '0')) to
    int, computed with integer arithmetic instead of strings.
    """
    c = _c(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def parse_date(c: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """String in ``fmt`` to date (X5); timestamps are cast."""
    return F.to_date(_c(c), fmt)


def date_sequence(start: str | Column, n: int) -> Column:
    """Array of n + 1 daily dates beginning at ``start`` (X11); explode it."""
    s = _c(start)
    return F.sequence(s, F.date_add(s, n))


def with_calendar(df: DataFrame, date_col: str = "date", parts=("year", "month", "day", "fulldate"),
                  weekday: bool = False) -> DataFrame:
    """Add calendar columns in one projection (P8 + X1/X2/X4)."""
    exprs = {}
    dp = date_parts(date_col)
    for p in parts:
        exprs[p] = fulldate(date_col) if p == "fulldate" else dp[p]
    if weekday:
        exprs["weekday"] = day_of_week(date_col)
    return df.withColumns(exprs)
