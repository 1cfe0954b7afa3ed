"""Queries with SQL must equal DuckDB on sf0.01; all queries must be registered, with the contract's columns and types."""

import pytest

from conftest import SF01, SF001
from oracle_compare import canon, duck

import __spark_entry__ as entry
from tidecast.llm.catalog import QUERIES

COLUMNS = {
    1: "query_id bigint, rank int, vec_id bigint, score bigint",
    2: "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    3: "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    4: "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    5: "doc_id bigint, fingerprint string, component_id bigint",
    6: "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    7: "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    8: "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    9: "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    10: "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
}


@pytest.mark.parametrize("name", sorted(n for n, (_f, sql) in QUERIES.items() if sql))
def test_equals_duckdb(spark, name):
    got = canon(QUERIES[name][0](spark, SF01).toPandas())
    want = canon(duck(SF01).sql(QUERIES[name][1]).df())
    assert got == want


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(spark, name):
    types = dict(QUERIES[name][0](spark, SF001).dtypes)
    for column in COLUMNS[int(name[2:].split("_")[0])].split(", "):
        n, kind = column.split(" ")
        assert types.get(n) == kind, n


def test_registered():
    queries = entry.queries()
    assert set(QUERIES) | {"pipeline"} <= set(queries) and len([n for n in queries if n.startswith("op")]) == 10
    assert set(entry.oracle_sql()) <= set(queries)
