"""SQL over registered views with bound parameters (Q1)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def sql_view(df: DataFrame, name: str, query: str, args: dict | None = None) -> DataFrame:
    """Register ``df`` as temp view ``name`` and run ``query`` with named ``args``.

    Values are bound as parameters (``:name`` markers) instead of being
    pasted into the text, so the statement is analysed once, with literals
    that Catalyst can fold.
    """
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(query, args=args or {})
