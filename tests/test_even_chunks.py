"""Data-cut buckets: chunked equals plain whatever the order column's type, gaps, NULL keys and NULL times."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidecast.operators import fill, index, split


def table(spark, kind, n=400, seed=1):
    rng = random.Random(seed)
    data = [(rng.choice(["a", "a", "a", "b", None]), i * i if i % 2 else i, rng.choice([None, float("nan"), 1.0, float(i)]), f"r{i}") for i in range(n)]
    df = spark.createDataFrame(data, "k string, t long, v double, note string").dropDuplicates(["k", "t"])
    return df.withColumn("t", {"long": F.col("t"), "date": F.date_from_unix_date((F.col("t") % 20000).cast("int")), "double": F.col("t") / 7,
                               "timestamp": F.timestamp_micros(F.col("t") * 10**6), "timestamp_ntz": F.timestamp_micros(F.col("t") * 10**6).cast("timestamp_ntz")}[kind]
                         ).dropDuplicates(["k", "t"])


@pytest.mark.parametrize("kind", ["long", "date", "double", "timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("by", ["k", ()])
def test_even_equals_plain(spark, kind, by):
    df = table(spark, kind)
    if not by:
        df = df.dropDuplicates(["t"])
    df = df.checkpoint()
    one = F.lit(0)  # a single bucket: the plain window
    for op in (lambda c: index.row_index(df, "t", by, count="n", chunk=c), lambda c: fill.forward_fill(df, ["v"], "t", by, chunk=c),
               lambda c: fill.ffill_bfill(df, ["v"], "t", by, chunk=c), lambda c: fill.lag_fill(df, ["v"], "t", by, chunk=c),
               lambda c: fill.lead_fill(df, ["v"], "t", by, chunk=c), lambda c: split.ordered_split(df, 0.7, "t", by, chunk=c)):
        assert rows(op("even")) == rows(op(one))


def test_empty_table_null_times_and_a_constant(spark):
    df = spark.createDataFrame([], "k string, t long, v double")
    assert fill.forward_fill(df, ["v"], "t", "k", chunk="even").collect() == []
    df = spark.createDataFrame([("a", None, 1.0), ("a", 3, None), ("a", 3, 2.0), ("b", None, None)], "k string, t long, v double")
    assert len(index.row_index(df, ["t", "v"], "k", chunk="even").collect()) == 4
    assert rows(fill.forward_fill(df, ["v"], ["t", "v"], "k", chunk="even")) == rows(fill.forward_fill(df, ["v"], ["t", "v"], "k"))
