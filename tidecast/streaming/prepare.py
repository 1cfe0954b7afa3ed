"""Preparation inside a stream (T3): raw bars in, filled, indexed and scored rows out.

Each key keeps a small state between micro-batches: the last value of every series, the next index, how far it has been
emitted, and the rows that wait for earlier ones. What comes out equals the batch preparation (join, forward fill, drop
incomplete rows, dense index) however the rows are cut into batches.
"""

from __future__ import annotations

import os
import pickle
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from tidecast.operators._chunks import as_list
from tidecast.operators.models import predict_grouped_linear
from tidecast.session import shared_path

_STATE = "frontier long, next long, held binary"


def _advance(state: dict, rows: pd.DataFrame, fill: Sequence[str], keep: Sequence[str], delay: int):
    """(new state, emitted rows) when ``rows`` (with ``_day``, days since the epoch) arrive for one key.

    Rows up to the key's newest day less ``delay`` are emitted in order of day; later ones wait. A row that isn't newer
    than what has been emitted is late: it comes out marked, without an index, and changes nothing."""
    late = rows[rows["_day"] <= state["frontier"]]
    waiting = pd.concat([x for x in (state["held"], rows[rows["_day"] > state["frontier"]]) if x is not None and len(x)] or [rows.iloc[:0]])
    out = [late.assign(late=True, idx=pd.array([pd.NA] * len(late), "Int64"))]
    if len(waiting):
        upto = int(waiting["_day"].max()) - delay
        ready = waiting[waiting["_day"] <= upto].sort_values("_day", kind="stable")
        held = waiting[waiting["_day"] > upto]
        if len(ready):
            ready = ready.copy()
            for c in fill:
                first = pd.Series([state["last"].get(c, np.nan)])
                ready[c] = pd.concat([first, ready[c].astype(float)]).ffill().to_numpy()[1:]
            last = {c: float(ready[c].iloc[-1]) for c in fill}
            complete = ready.dropna(subset=list(keep))
            idx = state["next"] + np.arange(len(complete))
            out.append(complete.assign(late=False, idx=pd.array(idx, "Int64")))
            state = {"frontier": int(ready["_day"].iloc[-1]), "next": state["next"] + len(complete), "last": last, "held": held}
        else:
            state = {**state, "held": held}
    return state, pd.concat(out)


def prepare_stream(bars: DataFrame, series_wide: DataFrame, cols: Sequence[str], by="symbol", on: str = "date", delay: int = 0) -> DataFrame:
    """A stream of raw bars to prepared rows: left join with the series of the day, forward fill by key, incomplete rows
    dropped, dense index. Output: the columns of ``bars``, ``cols``, ``idx`` and ``late``.

    ``series_wide`` is a stored table (stream-static join); ``cols`` are doubles, NaN counts as missing, as in
    ``prepare``. ``on`` is a date, not NULL, once per key. ``delay`` is the number of days that rows wait for
    earlier ones: rows that come at most so many days after newer rows of their key are put in order, and the last
    ``delay`` days of a key come out once newer rows arrive. With 0 every row comes out at once. Rows older than what has been emitted are
    late: they come out with ``late`` true and no index, once per arrival. State per key: one value per series and
    the rows of ``delay`` days. A row without a key is incomplete, as in ``prepare``.
    """
    key, plain = as_list(by)[0], [c for c in bars.columns]
    joined = bars.join(series_wide.select(on, *[F.col(c).cast("double").alias(c) for c in cols]), on, "left").select(*plain, *cols)
    joined = joined.withColumn("_day", F.unix_date(on))
    out_schema = T.StructType([*joined.select(*plain, *cols).schema.fields, T.StructField("idx", T.LongType()), T.StructField("late", T.BooleanType())])
    names = out_schema.names
    must = [*plain, *cols]

    def step(_key, batches, store):
        if store.exists:
            frontier, following, held = store.get
            last, waiting = pickle.loads(bytes(held))
        else:
            frontier, following, last, waiting = -(1 << 40), 0, {}, None
        state = {"frontier": frontier, "next": following, "last": last, "held": waiting}
        state, out = _advance(state, pd.concat(list(batches)), cols, must, delay)
        store.update((state["frontier"], state["next"], pickle.dumps((state["last"], state["held"]))))
        yield out[names]

    return joined.groupBy(key).applyInPandasWithState(step, out_schema, _STATE, "append", GroupStateTimeout.NoTimeout)


def prepare_and_score_stream(spark: SparkSession, source_dir: str, schema: T.StructType, series_wide: DataFrame, cols: Sequence[str],
                             coefs: DataFrame, features: Sequence[str], by="symbol", sink_dir: str | None = None, delay: int = 0) -> str:
    """Prepare and score the raw bars that have arrived at ``source_dir`` since the last call; returns the sink folder.

    State and progress live in ``<sink_dir>/_checkpoint``: calling again with the same sink goes on where the last call
    ended, exactly once. Late rows are written too, marked and without a prediction."""
    if sink_dir is None:
        sink_dir = os.path.join(shared_path(spark, "prepared"), "data")
    bars = spark.readStream.schema(schema).parquet(source_dir)
    ready = prepare_stream(bars, series_wide, cols, by, delay=delay)
    scored = predict_grouped_linear(coefs, ready, features, by)
    scored = scored.withColumn("prediction", F.when(~F.col("late"), F.col("prediction")))
    q = scored.writeStream.format("parquet").option("path", sink_dir).option("checkpointLocation", os.path.join(sink_dir, "_checkpoint")) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    return sink_dir
