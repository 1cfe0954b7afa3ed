"""Plan shape guards: patterns that do not scale must not appear in registered queries."""

import re

import pytest

from conftest import SF001
from plan_lint import plan_text

from tidecast.plans.registry import all_queries

REG = all_queries()
FAST = sorted(n for n, (_f, sql) in REG.items() if sql)
SPEC = re.compile(r"windowspecdefinition\(([^,)]*)")


def whole_table_windows(txt: str) -> list[str]:
    """Window lines with no partition key that are not over a per-chunk summary (ordered by the chunk)."""
    bad = []
    for line in txt.split("\n"):
        if "Window [" not in line:
            continue
        for first in SPEC.findall(line):
            # no partition key: the spec starts with the ordering or the frame
            if (" ASC" in first or " DESC" in first or first.startswith("specifiedwindowframe")) \
                    and not first.startswith("_chunk"):
                bad.append(line[:300])
    return bad


def test_guard_flags_an_unkeyed_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.range(10).withColumn("x", F.lag("id").over(Window.orderBy("id")))
    assert whole_table_windows(plan_text(df))


@pytest.mark.parametrize("name", FAST)
def test_no_unscalable_operators(spark, name):
    txt = plan_text(REG[name][0](spark, SF001))
    assert "BroadcastNestedLoopJoin" not in txt
    assert "CartesianProduct" not in txt
    assert "BatchEvalPython" not in txt  # no row-at-a-time Python UDF
    assert not whole_table_windows(txt)


def test_scan_pruning(spark):
    txt = plan_text(REG["bars_from_ticks"][0](spark, SF001))
    cols = re.search(r"FileScan parquet \[([^\]]*)\]", txt).group(1)
    names = {c.split("#")[0] for c in cols.split(",")}
    assert names == {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                     "l_shipdate"}


@pytest.mark.parametrize("name", ["rmse", "r2", "predict", "actual_vs_predicted", "shap_linear", "shap_summary", "predict_future", "linear_regression"])
def test_model_queries_read_one_prepared_table(spark, name):
    """Fit, scoring and explanation read the stored table: the given tables are scanned for it once, and not again."""
    df = REG[name][0](spark, SF001)
    df.collect()
    txt = plan_text(df)
    assert "FileScan" not in txt and "Scan ExistingRDD" in txt


def test_stream_gets_a_table_of_coefficients(spark, monkeypatch):
    from tidecast.plans import catalog_models
    seen = []
    real = catalog_models.score_stream

    def spy(*args, **kw):
        seen.append(plan_text(kw["coefs"]))
        return real(*args, **kw)
    monkeypatch.setattr(catalog_models, "score_stream", spy)
    REG["score_new_bars"][0](spark, SF001).collect()
    assert len(seen) == 1 and "Aggregate" not in seen[0] and "FileScan" not in seen[0]


def test_sequences_cross_the_shuffle_once_and_a_halo(spark):
    """A window of 400 rows every 25 with 20 steps ahead: each row goes to at most two buckets, not to 17 windows."""
    from pyspark.sql import functions as F
    from tidecast.operators.sequences import build_sequences
    n = 20_000
    df = spark.range(n).select(F.lit("a").alias("symbol"), F.col("id").alias("date"), F.col("id").cast("double").alias("v"))
    out = build_sequences(df, ["v"], "date", "symbol", window=400, stride=25, telescope=20)
    out.write.format("noop").mode("overwrite").save()
    assert out.count() == (n - 420) // 25 + ((n - 420) % 25 > 0)
    biggest = out.agg(F.max(F.size("inputs")), F.max(F.size("labels"))).first()
    assert tuple(biggest) == (400, 20)


def _final(df) -> str:
    df.collect()
    return plan_text(df).rsplit("== Initial Plan ==", 1)[0]


@pytest.mark.parametrize("chunk", ["year", "even"])
@pytest.mark.parametrize("op", ["row_index", "forward_fill", "ffill_bfill", "lag_fill", "lag_diff", "ordered_split"])
def test_chunked_operators_scan_once_and_deal_rows_once(spark, tmp_path, op, chunk):
    """The rows cross one exchange, which the summary of buckets reuses; no aggregate sorts."""
    from pyspark.sql import functions as F
    from tidecast.operators import fill, index, split
    spark.range(3000).select(F.lit("a").alias("symbol"), F.date_add(F.lit("2001-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
                             F.when(F.col("id") % 7 > 3, F.col("id") * 1.0).alias("v"), F.lit("other").alias("note")).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    out = {"row_index": lambda: index.row_index(df, "date", "symbol", count="n", chunk=chunk),
           "forward_fill": lambda: fill.forward_fill(df, ["v"], "date", "symbol", chunk=chunk),
           "ffill_bfill": lambda: fill.ffill_bfill(df, ["v"], "date", "symbol", chunk=chunk),
           "lag_fill": lambda: fill.lag_fill(df, ["v"], "date", "symbol", chunk=chunk),
           "lag_diff": lambda: fill.lag_diff(df, "v", "date", "symbol", chunk=chunk),
           "ordered_split": lambda: split.ordered_split(df, 0.8, "date", "symbol", chunk=chunk)}[op]()
    txt = _final(out)
    assert txt.count("FileScan") == 1 and txt.count("REPARTITION_BY_COL") - txt.count("ReusedExchange") == 1
    assert "SortAggregate" not in txt and txt.count("ReusedExchange") == 1


def test_even_buckets_spread_one_key_and_uneven_times(spark):
    """One key with all rows, most of them within one day: no bucket has more than its share and the ties at its end."""
    from pyspark.sql import functions as F
    from tidecast.operators._chunks import even_chunk
    df = spark.range(100_000).select(F.when(F.col("id") < 90_000, F.lit(1_000_000_000) + F.col("id")).otherwise(F.col("id") * 1_000_000).alias("t"))
    for x in (df, df.select(F.timestamp_micros("t").alias("t")), df.select((F.col("t") / 3).alias("t"))):
        sizes = [r["count"] for r in x.groupBy(even_chunk(x, "t", 64).alias("b")).count().collect()]
        assert 55 <= len(sizes) <= 64 and max(sizes) < 2 * 100_000 / 64


def test_bucketed_bars_are_read_once_and_never_dealt_again(spark):
    """Fill, as-of join, index, split and rolling frames by the key of the buckets."""
    import re
    from tidecast.operators import index, joins, sequences, split
    from tidecast.sources import fixtures as fx
    from tidecast.sources.sinks import write_bucketed
    table = write_bucketed(fx.bars_multi(spark, SF001), "bars", "symbol", "date", buckets=8)
    bars, series = spark.table(table), fx.series_wide(spark, SF001).checkpoint()
    for fill in ("after", "asof"):
        df = joins.enrich(bars, series, on="date", by="symbol", fill=fill)
        df = split.ordered_split(index.row_index(df, "date", by="symbol"), 0.8, "date", by="symbol")
        df = sequences.rolling_frame_sequences(df, ["close"], "date", by="symbol", window=5, telescope=2)
        txt = _final(df)
        assert txt.count(f"FileScan parquet spark_catalog.default.{table}") == 1
        # whatever is exchanged is the series': no exchange has the bars' scan below it
        at = txt.index("FileScan")
        depth = lambda line: len(re.match(r"[ :|+\-*()\d]*", line).group(0))
        above, level = [], depth(txt[txt.rindex("\n", 0, at) + 1:])
        for line in reversed(txt[:at].rstrip().split("\n")[:-1]):
            if depth(line) < level:
                above.append(line)
                level = depth(line)
        assert above and not any("Exchange" in x for x in above), above


def test_asof_by_day_reads_the_left_side_once(spark, tmp_path):
    from tidecast.operators.joins import asof_join
    from tidecast.sources import fixtures as fx
    fx.bars_multi(spark, SF001).write.parquet(f"{tmp_path}/bars")
    fx.series_wide(spark, SF001).write.parquet(f"{tmp_path}/series")
    bars, series = spark.read.parquet(f"{tmp_path}/bars"), spark.read.parquet(f"{tmp_path}/series")
    txt = _final(asof_join(bars, series, "date"))
    assert txt.count("/bars]") == 1
