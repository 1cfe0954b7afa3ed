"""Moments by period merge into the full fit; a period given again replaces itself."""

import pytest
from pyspark.sql import functions as F

from tidecast.operators import models


@pytest.fixture(scope="module")
def data(spark):
    df = spark.range(900).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("s"), F.col("id") % 3)).alias("k"), (F.col("id") / 100).cast("int").alias("year"),
                                 ((F.xxhash64("id") % 1000) / 10.0 + 1e6).alias("a"), ((F.hash("id") % 100) / 7.0).alias("b"), (F.sin("id") * 3).alias("c"))
    df = df.withColumn("close", F.col("a") * 2 - F.col("b") + F.col("c") * F.col("id") / 500)
    return df.withColumn("b", F.when(F.col("id") % 50 != 0, F.col("b"))).checkpoint()


def key(df):
    return {r[0] if df.columns[0] == "k" else 0: r for r in df.collect()}


@pytest.mark.parametrize("by", ["k", ()])
@pytest.mark.parametrize("features", [["a"], ["a", "b", "c"]])
def test_refit_equals_the_full_fit(spark, data, tmp_path, by, features):
    path = f"{tmp_path}/m"
    models.store_moments(data.where("year < 4"), path, features, "close", by, "year")
    models.store_moments(data.where("year >= 4 AND id % 2 = 0"), path, features, "close", by, "year")
    models.store_moments(data.where("year >= 4"), path, features, "close", by, "year")  # the late rows' periods, whole
    want, got = key(models.fit_grouped_linear(data, features, by=by)), key(models.refit_linear(spark, path, features, by))
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert got[k]["n"] == w["n"]
        for c in ["intercept", *[f"coef_{f}" for f in features]]:
            assert abs(got[k][c] - w[c]) <= 1e-6 * max(1, abs(w[c])), (k, c, got[k][c], w[c])
    old = key(models.refit_linear(spark, path, features, by, where="year < 4"))
    assert sum(r["n"] for r in old.values()) == data.where("year < 4").dropna(subset=features).count()


def test_periods_without_usable_rows_and_an_empty_table(spark, data, tmp_path):
    path = f"{tmp_path}/m"
    models.store_moments(data.withColumn("a", F.when(F.col("year") > 0, F.col("a"))), path, ["a"], "close", "k", "year")
    assert sum(r["n"] for r in models.refit_linear(spark, path, ["a"], "k").collect()) == 800
    assert models.merge_moments(models.linear_moments(data.limit(0), ["a", "b"], "close", "k"), ["a", "b"], "k").count() == 0
