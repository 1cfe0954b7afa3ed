"""The stream's preparation equals the batch's over any cut into batches; late rows."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidecast.plans.flows import prepare
from tidecast.streaming.prepare import _advance, prepare_and_score_stream


def bars(spark):
    rng = random.Random(2)
    rows = [(s, d, None if rng.random() < 0.05 else float(d), float(rng.randint(1, 99))) for s in ("a", "b", None) for d in range(60) if rng.random() < 0.8]
    df = spark.createDataFrame(rows, "symbol string, d int, open double, close double")
    series = spark.createDataFrame([(d, float(d) if d % 9 == 4 else (float("nan") if d % 9 == 5 else None)) for d in range(60)], "d int, m double")
    day = lambda x: x.withColumn("date", F.date_add(F.lit("2020-01-01").cast("date"), "d")).drop("d")
    return day(df).select("symbol", "date", "open", "close").checkpoint(), day(series).checkpoint()


def key(rows):
    return sorted(((r.symbol or "", r.idx, r.date, r.open, r.close, r.m) for r in rows))


@pytest.mark.parametrize("cut", ["by day", "shuffled within ten days"])
def test_equals_batch_over_cuts(spark, tmp_path, cut):
    df, series = bars(spark)
    want = key(prepare(df, series, ["m"], by="symbol").collect())
    coefs = spark.createDataFrame([("a", 1.0, 2.0), ("b", 0.0, 1.0)], "symbol string, intercept double, coef_open double")
    rng = random.Random(5)
    day = F.datediff("date", F.lit("2020-01-01").cast("date"))
    if cut == "by day":
        parts, delay = [df.where((day >= a) & (day < b)) for a, b in ((0, 1), (1, 17), (17, 18), (18, 60))], 0
    else:
        # rows of each ten days come in any order over two deliveries; a last delivery lets everything out
        first = (F.xxhash64("symbol", "date") % 2 == 0)
        parts, delay = [], 10
        for a in range(0, 60, 10):
            ten = df.where((day >= a) & (day < a + 10))
            parts += [ten.where(first), ten.where(~first)]
        rng.shuffle(parts[:2])
        end = df.select("symbol").distinct().select("symbol", F.lit("2021-01-01").cast("date").alias("date"), F.lit(1.0).alias("open"), F.lit(1.0).alias("close"))
        parts.append(end)
    landing, sink = f"{tmp_path}/in", f"{tmp_path}/out"
    for p in parts:
        p.write.mode("append").parquet(landing)
        prepare_and_score_stream(spark, landing, df.schema, series, ["m"], coefs, ["open"], sink_dir=sink, delay=delay)
    got = spark.read.parquet(sink).collect()
    assert not any(r.late for r in got)
    assert key(r for r in got if r.date.year == 2020) == want
    assert all(r.prediction == 1.0 + 2.0 * r.open for r in got if r.symbol == "a")
    assert {r.symbol for r in got} == {"a", "b"}  # a row without a key is incomplete, as in the batch


def test_late_rows_come_out_marked_and_change_nothing(spark, tmp_path):
    df, series = bars(spark)
    coefs = spark.createDataFrame([("a", 1.0, 2.0)], "symbol string, intercept double, coef_open double")
    landing, sink = f"{tmp_path}/in", f"{tmp_path}/out"
    old = df.where("date < '2020-01-10'")
    for p in (df.where("date >= '2020-01-10' AND date < '2020-02-10'"), old, df.where("date >= '2020-02-10'")):
        p.write.mode("append").parquet(landing)
        prepare_and_score_stream(spark, landing, df.schema, series, ["m"], coefs, ["open"], sink_dir=sink)
    got = spark.read.parquet(sink).collect()
    late = [r for r in got if r.late]
    assert len(late) == old.count() and all(r.idx is None and r.prediction is None for r in late)
    assert key(r for r in got if not r.late) == key(prepare(df.where("date >= '2020-01-10'"), series, ["m"], by="symbol").collect())


def test_one_step_keeps_what_must_wait():
    rows = pd.DataFrame({"_day": [3, 1, 9], "m": [float("nan"), 5.0, 7.0], "x": [1.0, 1.0, 1.0]})
    state = {"frontier": -9, "next": 0, "last": {}, "held": None}
    state, out = _advance(state, rows, ["m"], ["m", "x"], delay=5)
    assert list(out["_day"]) == [1, 3] and list(out["m"]) == [5.0, 5.0] and list(out["idx"]) == [0, 1] and list(state["held"]["_day"]) == [9]
    state, out = _advance(state, pd.DataFrame({"_day": [2, 20], "m": [1.0, float("nan")], "x": [1.0, 1.0]}), ["m"], ["m", "x"], delay=5)
    assert list(out["late"]) == [True, False] and list(out["_day"]) == [2, 9] and state["next"] == 3 and state["frontier"] == 9
