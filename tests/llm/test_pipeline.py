"""The corpus pipeline, each stage against a brute-force version on its own input."""

from collections import defaultdict

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from conftest import SF01, SF001
from test_mixing import slow_targets
from test_quality import breaks, slow
from test_simhash import slow_components, slow_fingerprint
from tidecast.llm.bpe import public_vocabulary
from tidecast.llm.common import stored


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    rows = [r.asDict() for r in docs.collect()]
    # quality rules
    docs = stored(cp.STAGES[0][1](spark, docs, sf), "s0")
    rows = [r for r in rows if not breaks(slow(r["text"]))]
    assert docs.columns == names and as_rows(docs) == sorted((tuple(r.values()) for r in rows), key=str)
    # near duplicates
    docs = stored(cp.STAGES[1][1](spark, docs, sf), "s1")
    rows.sort(key=lambda r: r["doc_id"])
    top = slow_components([slow_fingerprint(r["text"]) for r in rows], 2)
    rows = [r for i, r in enumerate(rows) if top[i] == i]
    assert docs.columns == names and as_rows(docs) == sorted((tuple(r.values()) for r in rows), key=str)
    # mixing
    mixed = stored(cp.STAGES[2][1](spark, docs, sf), "s2")
    assert mixed.columns == names
    copies, source, size = defaultdict(int), {r["doc_id"]: r["source"] for r in rows}, {r["doc_id"]: len(r["text"].encode().split()) for r in rows}
    for r in mixed.collect():
        copies[r.doc_id] += 1
        assert r.asDict() in rows if sf == SF001 else r.doc_id in size
    assert max(copies.values()) <= 2
    total, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, s in source.items():
        total[s] += size[i]
        taken[s] += size[i] * copies[i]
        most[s] = max(most[s], size[i])
    want = slow_targets(total)
    assert all(abs(taken[s] - want[s]) <= most[s] + 1 for s in total)
    # encoding
    library = Tokenizer.from_file(public_vocabulary())
    text = {r["doc_id"]: r["text"] for r in rows}
    out = cp.STAGES[3][1](spark, mixed, sf).collect()
    assert len(out) == sum(copies.values())
    for r in out[:100]:
        assert r.n_tokens == len(library.encode(text[r.doc_id], add_special_tokens=False).ids)


def test_run(spark):
    out = cp.run(spark, SF001)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 50
    assert as_rows(out) == as_rows(cp.run(spark, SF001))


def test_alike_rows_nulls_and_empty(spark):
    good = "the cat sat on the mat and looked at all of the birds there on the roof"
    other = "a quite different text with some other words in it that is not the same as any of the ones before"
    rows = [(None, good, "a", 1), (4, good, "a", 1), (4, good, "a", 1), (None, other, None, None), (None, other, None, None), (7, None, "b", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _row int")
    kept = cp.near_duplicates(spark, cp.quality_rules(spark, df, ""), "")
    assert as_rows(kept) == sorted([(4, good, "a", 1), (None, other, None, None)], key=str)
    mixed = cp.mixing_weights(spark, df, "")
    assert set(map(tuple, mixed.collect())) <= set(rows)
    for _, stage in cp.STAGES:
        assert stage(spark, df.limit(0), "").count() == 0
