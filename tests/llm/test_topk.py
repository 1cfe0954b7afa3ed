"""Exact top-k search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.llm.topk import exact_top_k, merge_lists

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("rank", T.StringType()), T.StructField("id", T.StringType())])


def brute(rows, wanted, k):
    fit = [(i, v) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    whole = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in fit]
    out = []
    for qi in sorted({i for i, _ in whole if wanted(i)}):
        q = min(v for i, v in whole if i == qi)
        found = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in whole if i != qi)[:k]
        out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return out


def got(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("block_bytes", [64, 1 << 20])
def test_equals_brute_force(spark, block_bytes):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6).round(1)], "x", "y") for i in range(120)]
    rows += [(200 + i, [0.5] * 6, None, None) for i in range(60)]          # ties
    rows += [(300, None, "", ""), (301, [1.0, None], "", ""), (302, [float("nan")], "", ""), (303, [float("inf")], "", ""),
             (None, [1.0] * 6, "", ""), (304, [], "", ""), (305, [2.0], "", ""), (100, rows[3][1], "", "")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = brute(rows, lambda i: i % 50 == 0, 7)
    assert got(exact_top_k(df, df.filter(F.col("vec_id") % 50 == 0), 7, block_bytes=block_bytes)) == sorted(want)


def test_few_candidates_large_values_and_empty(spark):
    rows = [(0, [3e18, 1.0], "", ""), (1, [3e18, 5.0], "", ""), (2, [-1.0, 2.0], "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    res = got(exact_top_k(df, df.filter("vec_id = 0"), 10))
    assert [r[1:3] for r in res] == [(1, 1), (2, 2)]
    assert res[0][3] == 2**63 - 1 and res[1][3] == -2**63
    none = df.limit(0)
    assert exact_top_k(none, none).count() == 0 and exact_top_k(df, none).count() == 0


def test_tree_merge(spark):
    rows = [(q, p, p * 10 + j, (p * 7 + j) % 5) for q in (1, 2) for p in range(70) for j in range(3)]
    df = spark.createDataFrame(rows, "query_id long, part int, vec_id long, score long")
    want = sorted((q, r + 1, v, -s) for q in (1, 2) for r, (s, v) in enumerate(sorted((-s, v) for qq, _, v, s in rows if qq == q)[:4]))
    assert got(merge_lists(df, 4, 70, fan_in=4)) == want
