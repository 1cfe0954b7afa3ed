from pyspark.sql import functions as F

from conftest import SF01, rows
from tidecast.operators import index, split
from tidecast.sources import fixtures as fx


def test_chunked_index_equals_plain(spark):
    b = fx.bars_multi(spark, SF01)
    a = index.row_index(b, "date", by="symbol")
    c = index.row_index(b, "date", by="symbol", chunk="year", count="n")
    assert rows(a) == rows(c.drop("n"))
    n = c.groupBy("symbol").agg(F.max("idx").alias("m"), F.first("n").alias("n")).collect()
    assert all(r.m + 1 == r.n for r in n)


def test_ordered_split_disjoint_cover_and_time_order(spark):
    s = split.ordered_split(fx.bars_multi(spark, SF01), 0.8, "date", by="symbol")
    stats = s.groupBy("symbol").agg(
        F.count("*").alias("n"), F.sum(F.col("is_train").cast("int")).alias("tr"),
        F.max(F.when(F.col("is_train"), F.col("date"))).alias("last_train"),
        F.min(F.when(~F.col("is_train"), F.col("date"))).alias("first_test")).collect()
    for r in stats:
        assert r.tr == int(r.n * 0.8)
        assert r.last_train < r.first_test
    chunked = split.ordered_split(fx.bars_multi(spark, SF01), 0.8, "date", by="symbol", chunk="year")
    assert rows(s) == rows(chunked)


def test_tail_split_and_limits(spark):
    s = split.tail_split(fx.bars_multi(spark, SF01), 100, "date", by="symbol")
    per = s.where(~F.col("is_train")).groupBy("symbol").count().collect()
    assert all(r["count"] == 100 for r in per)
    assert split.limit_n(fx.bars(spark, SF01), 7).count() == 7


def test_hash_split_is_repeatable(spark):
    b = fx.bars_multi(spark, SF01)
    a = split.hash_split(b, ["symbol", "date"], (0.8, 0.2), seed=7)
    c = split.hash_split(b.repartition(5), ["symbol", "date"], (0.8, 0.2), seed=7)
    assert rows(a) == rows(c)
    frac = a.where("split = 0").count() / a.count()
    assert 0.75 < frac < 0.85


def test_latest_and_first(spark):
    b = fx.bars_multi(spark, SF01)
    last = split.latest(b, "symbol", "date")
    m = b.groupBy("symbol").agg(F.max("date").alias("date"))
    assert rows(last.select("symbol", "date")) == rows(m)


def test_partition_count(spark):
    df = spark.range(100).repartition(4)
    assert index.partition_count(df).collect()[0].partitions == 4


def test_partition_rows(spark):
    df = spark.range(100).repartition(4)
    assert tuple(index.partition_rows(df).first()) == (4, 0, 100)
    assert tuple(index.partition_rows(spark.range(2).coalesce(1).union(spark.range(0))).first())[2] == 2
    one = spark.createDataFrame([(1,)] * 5, "k int").repartition(6, "k")
    assert tuple(index.partition_rows(one).first()) == (6, 5, 5)
