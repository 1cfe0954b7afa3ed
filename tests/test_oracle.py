"""Every registered query with oracle text must equal DuckDB on sf0.01; the others must run."""

import math

import pytest

from conftest import SF01
from oracle_compare import canon, duck
from schema_compare import DUCK_TO_SPARK

from tidecast.plans.registry import all_queries

REG = all_queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(n for n, (_f, sql) in REG.items() if sql))
def test_query_matches_oracle(spark, con, name):
    fn, sql = REG[name]
    df = fn(spark, SF01)
    types = {f.name.lower(): f.dataType.simpleString() for f in df.schema.fields}
    duck_types = {r[0].lower(): DUCK_TO_SPARK.get(r[1], r[1]) for r in con.sql(f"DESCRIBE ({sql})").fetchall()}
    assert types == duck_types
    got = canon(df.toPandas())
    want = canon(con.sql(sql).df())
    assert got[0] == want[0]
    assert got[1] == want[1]


def _finite(rows, *cols):
    assert rows and all(math.isfinite(r[c]) for r in rows for c in cols)


#: What must hold for the queries that SQL can't state, over their rows on sf0.01.
CHECKS = {
    "random_forest": lambda r: _finite(r, "prediction", "close"),
    "gbt": lambda r: _finite(r, "prediction", "close"),
    "assembled_estimator": lambda r: _finite(r, "prediction", "close"),
    "sink_model": lambda r: _finite(r, "prediction"),
    "compare_models": lambda r: _finite(r, "rmse", "r2") or {x.model for x in r} == {"lr", "rf", "gbt"},
    "model_choice": lambda r: _finite(r, "rmse"),
    "pooled_model": lambda r: _finite(r, "rmse"),
    "grid_search_cv": lambda r: _finite(r, "rmse") or len(r) == 9,
    "windowed_forecast": lambda r: _finite(r, "rmse", "rmse_scaled") or {x.horizon for x in r} == set(range(1, 21)),
    "feature_importance": lambda r: all(abs(sum(x.importance for x in r if x.model == m) - 1) < 1e-9 for m in ("rf", "gbt")),
    "lime": lambda r: _finite(r, "weight") or len(r) == 50,
    "lime_quartile": lambda r: _finite(r, "weight") or len(r) == 150,
    "shap_sampled": lambda r: _finite(r, "phi"),
    "shap_tree": lambda r: _finite(r, "phi") or len(r) == len({(x.model, x.symbol, x.idx, x.feature) for x in r}) == 2 * 12 * len({(x.symbol, x.idx) for x in r}),
}


@pytest.mark.parametrize("name", sorted(n for n, (_f, sql) in REG.items() if not sql))
def test_query_without_oracle(spark, name):
    rows = REG[name][0](spark, SF01).collect()
    assert CHECKS[name](rows) in (None, True)
    if name in ("random_forest", "gbt", "assembled_estimator", "sink_model"):
        # one row for each test row, and no other
        test = REG["tree_checks"][0](spark, SF01).first()
        assert len(rows) == len({(x.symbol, x.idx) for x in rows}) == test.scored


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["symbol", "rmse"]
    assert df.count() == 5
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", ["mllib_predict", "mllib_metrics", "mllib_saved_model", "lime_linear", "shap_sampled_linear"])
def test_pooled_queries_cover_all_symbols(spark, name):
    symbols = {r.symbol for r in REG["symbol_index"][0](spark, SF01).select("symbol").distinct().collect()}
    assert {r.symbol for r in REG[f"{name}_pooled"][0](spark, SF01).select("symbol").distinct().collect()} == symbols and len(symbols) == 5
