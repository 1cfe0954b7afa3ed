"""Joining bars with series by date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.operators._chunks import CHUNK, as_list, auto_chunk, chunk_expr, ntz_micros
from tidecast.operators.fill import forward_fill


def _ordered(u: DataFrame, keys, chunk) -> tuple[DataFrame, list, object]:
    """Add ``_o``, one exact bigint for (time, side), so the fill orders by a single
    primitive column and its chunk summaries stay hash aggregations; the chunk is
    taken from the time itself."""
    tt = u.schema["_t"].dataType.simpleString()
    if tt == "date":
        base = F.unix_date("_t").cast("long")
    elif tt.startswith("timestamp"):
        if tt == "timestamp_ntz":
            base = ntz_micros(F.col("_t"))
        else:
            base = F.unix_micros("_t")
    elif tt in ("tinyint", "smallint", "int", "bigint"):
        base = F.col("_t").cast("long")
    else:
        # no exact bigint: order by the time itself, then by the side
        chunk = auto_chunk(u, keys, "_t", chunk)
        return u, ["_t", "_side"], (chunk_expr(chunk, "_t") if chunk is not None else None)
    u = u.withColumn("_o", base * 2 + F.col("_side"))
    chunk = auto_chunk(u, keys, "_t", chunk)
    return u, ["_o"], (chunk_expr(chunk, "_t") if chunk is not None else None)


def _value_cols(right: DataFrame, on: str, keys, cols) -> list[str]:
    if cols is not None:
        return list(cols)
    return [c for c in right.columns if c != on and c not in keys]


def _maybe_broadcast(right: DataFrame, broadcast_right: bool | int | None) -> DataFrame:
    """Broadcast policy for the right side of a join.

    None   the planner decides from measured sizes: AQE converts the join to a
           broadcast only under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
    int n  a checked bound in bytes: broadcast only if the optimizer's own estimate
           of the right side is at most n; no job is run for the check
    """
    if broadcast_right is None or broadcast_right is False:
        return right
    if broadcast_right is True:
        raise ValueError("give broadcast_right as a bound in bytes, which is checked")
    size = int(str(right._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(right) if size <= int(broadcast_right) else right


def enrich(left: DataFrame, right: DataFrame, on: str = "date", by=(), cols=None, fill: str | None = None,
           chunk=None, broadcast_right: bool | int | None = None, per_column: bool = True) -> DataFrame:
    """Bars ⟕ series on ``on`` (and the ``by`` keys the right side has).

    fill=None     plain left join, every left row kept (J1)
    fill='after'  join, then forward fill over the left rows' order (J2):
                  a value dated on a day absent from the left is lost
    fill='before' forward fill on the right's own calendar, then join (J3):
                  a left date absent from the right gets NULL
    fill='asof'   latest right value at or before the left date (J4), per
                  column by default, or the whole latest row (``per_column=False``)
    """
    keys = [k for k in as_list(by) if k in right.columns]
    vals = _value_cols(right, on, keys, cols)
    r = right.select(*keys, on, *vals)
    if fill == "asof":
        return asof_join(left, r, on=on, by=keys, cols=vals, chunk=chunk, per_column=per_column)
    if fill == "before":
        r = forward_fill(r, vals, order=on, by=keys, chunk=chunk)
    out = left.join(_maybe_broadcast(r, broadcast_right), [*keys, on], "left")
    if fill == "after":
        out = forward_fill(out, vals, order=on, by=as_list(by), chunk=chunk)
    elif fill not in (None, "before"):
        raise ValueError(f"unknown fill {fill!r}")
    return out


def complete_case_join(left: DataFrame, right: DataFrame, on: str = "date", by=(), cols=None) -> DataFrame:
    """Left join, then drop rows with any missing value (J5): bars with every series present."""
    from tidecast.operators.profile import drop_missing
    return drop_missing(enrich(left, right, on=on, by=by, cols=cols))


def asof_join(left: DataFrame, right: DataFrame, on: str = "date", by=(), cols=None,
              chunk=None, per_column: bool = True) -> DataFrame:
    """For each left row, the latest right value at or before ``left.on``.

    per_column=True   each value column takes its latest non-NULL value, i.e.
                      an as-of join of every series on its own observations
                      (the same as joining each long series separately)
    per_column=False  the latest right row is taken whole, NULLs included, as
                      SQL ASOF LEFT JOIN on the wide table does

    Days (``on`` a date, right side without a key) are matched through a table of days. Otherwise
    built from a union and a window, never a range join: right rows carry
    their values, left times carry NULL, and a forward fill over
    (key, time; right before left at equal times) finds the match. Only the
    distinct left (key, time) pairs enter the union, so its size is bounded by
    the calendar and the right side, not by the left table; the matches are
    joined back on equality. ``chunk`` splits each key's timeline into buckets
    with the carry taken from a per-bucket summary.
    """
    keys = [k for k in as_list(by) if k in right.columns]
    vals = _value_cols(right, on, keys, cols)
    if keys:
        return _asof_keyed(left, right, on, keys, vals, chunk, per_column)
    right = right.where(F.col(on).isNotNull())
    if left.schema[on].dataType == right.schema[on].dataType == T.DateType():
        return _asof_days(left, right, on, vals, per_column)
    lt = left.select(F.col(on).alias("_t")).where("_t IS NOT NULL").distinct()
    if per_column:
        r = right.select(F.col(on).alias("_t"), F.lit(0).alias("_side"), *vals)
        lt = lt.select("_t", F.lit(1).alias("_side"), *[F.lit(None).cast(r.schema[v].dataType).alias(v) for v in vals])
        u, order, ck = _ordered(r.unionByName(lt), [], chunk)
        filled = forward_fill(u, vals, order=order, value=None, chunk=ck)
        matches = filled.where(F.col("_side") == 1).select(F.col("_t").alias(on), *vals)
        return left.join(matches, on, "left").select(*left.columns, *vals)
    rstruct = F.struct(*[F.col(v) for v in vals])
    r = right.select(F.col(on).alias("_t"), F.lit(0).alias("_side"), rstruct.alias("_r"))
    lt = lt.select("_t", F.lit(1).alias("_side"), F.lit(None).cast(r.schema["_r"].dataType).alias("_r"))
    u, order, ck = _ordered(r.unionByName(lt), [], chunk)
    filled = forward_fill(u, ["_r"], order=order, value=None, chunk=ck)
    matches = filled.where(F.col("_side") == 1).select(F.col("_t").alias(on), F.col("_r").alias("_m"))
    out = left.join(matches, on, "left")
    return out.select(*left.columns, *[F.col(f"_m.{v}").alias(v) for v in vals])


def _asof_days(left: DataFrame, right: DataFrame, on: str, vals, per_column: bool) -> DataFrame:
    """As-of join by day: every day of the right side stands for the days until its next one, so that the match is an equality.

    The right side is first reduced to one row per day, a table that the calendar bounds whatever the size of either side (the
    window runs over these rows only). The left side is read once and meets it in one join, a broadcast if
    the days' measured size allows. Left days after the last right one meet the last."""
    # of rows that share a day: per column a value that is not NULL, or else one row whole
    pick = [F.first(v, True).alias(v) for v in vals] if per_column else [F.first(F.struct(*[F.col(v) for v in vals])).alias("_r")]
    daily = right.groupBy(F.col(on).alias(CHUNK)).agg(*pick)
    w = Window.orderBy(CHUNK)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    values = [(F.last(v, True).over(upto) if per_column else F.col(f"_r.{v}")).alias(f"_v_{v}") for v in vals]
    spans = daily.select(CHUNK, F.lead(CHUNK).over(w).alias("_next"), *values)
    days = spans.select(F.explode(F.sequence(CHUNK, F.coalesce(F.date_sub("_next", 1), F.col(CHUNK)))).alias("_d"), *[f"_v_{v}" for v in vals])
    last = right.agg(F.max(on)).scalar()
    # a left row without a day has none to match
    day = F.when(F.col(on).isNotNull(), F.least(F.col(on), last))
    return left.withColumn("_d", day).join(days, "_d", "left").select(*left.columns, *[F.col(f"_v_{v}").alias(v) for v in vals])


def _asof_keyed(left: DataFrame, right: DataFrame, on: str, keys, vals, chunk, per_column: bool) -> DataFrame:
    """As-of join when the right side has the key: the left rows ride through the window
    themselves (as a struct), so the plan is one shuffle by (key[, bucket]) and no join back.

    A right row with a NULL key or NULL time matches nothing, as in SQL: such rows are left out. Left rows with
    one come through with NULL values, as no right row stands before them."""
    right = right.where(F.col(on).isNotNull())
    for k in keys:
        right = right.where(F.col(k).isNotNull())
    lstruct = F.struct(*[F.col(c) for c in left.columns])
    if per_column:
        carried = vals
        r = right.select(*keys, F.col(on).alias("_t"), F.lit(0).alias("_side"), *vals)
        rtypes = {v: r.schema[v].dataType for v in vals}
        lrows = left.select(*keys, F.col(on).alias("_t"), F.lit(1).alias("_side"),
                            *[F.lit(None).cast(rtypes[v]).alias(v) for v in vals], lstruct.alias("_l"))
    else:
        carried = ["_r"]
        r = right.select(*keys, F.col(on).alias("_t"), F.lit(0).alias("_side"),
                         F.struct(*[F.col(v) for v in vals]).alias("_r"))
        lrows = left.select(*keys, F.col(on).alias("_t"), F.lit(1).alias("_side"),
                            F.lit(None).cast(r.schema["_r"].dataType).alias("_r"), lstruct.alias("_l"))
    r = r.withColumn("_l", F.lit(None).cast(lrows.schema["_l"].dataType))
    u, order, ck = _ordered(r.unionByName(lrows), keys, chunk)
    filled = forward_fill(u, carried, order=order, by=keys, value=None, chunk=ck)
    out = filled.where(F.col("_side") == 1)
    if per_column:
        return out.select("_l.*", *vals)
    return out.select("_l.*", *[F.col(f"_r.{v}").alias(v) for v in vals])
