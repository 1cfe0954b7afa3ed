"""Mixing sources: targets, dual solution, rounding."""

import math
from collections import defaultdict

import numpy as np
import pytest

from conftest import SF01
from tidecast.llm.mixing import mix, mix_counts, op8_entropy_mix, targets


def slow_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped = {}
    while True:
        left = 1.5 * sum(sizes.values()) - sum(capped.values())
        rest = [s for s in order if s not in capped]
        share = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > 2 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 2.0 * sizes[s] for s in over}


def test_targets():
    for sizes in ({"a": 10, "b": 1000, "c": 5, None: 7}, {"b": 1}, {"z": 0, "y": 0}, {"a": 1, "B": 1, "é": 1, "": 4}, {}):
        assert targets(sizes) == pytest.approx(slow_targets(sizes) if sizes else {})
        assert sum(targets(sizes).values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_query_meets_targets(spark):
    rows = op8_entropy_mix(spark, SF01).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    size, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        d = docs[r.doc_id]
        assert r.size == len((d.text or "").encode().split())
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        size[d.source] += r.size
        taken[d.source] += r.taken
        largest[d.source] = max(largest[d.source], r.size)
    want = slow_targets(size)
    for r in rows:
        s = docs[r.doc_id].source
        assert r.source_size == size[s] and r.target == pytest.approx(want[s])
    for s in size:
        assert abs(taken[s] - want[s]) <= largest[s] + 1
    # rates are one exponential tilt per source: the log odds over the size is the same for all its documents
    tilt = defaultdict(list)
    for r in rows:
        if r["size"] and 1e-3 < r.rate < 2 - 1e-3:
            tilt[docs[r.doc_id].source].append(math.log(r.rate / (2 - r.rate)) / r["size"])
    assert tilt and all(np.ptp(t) <= 1e-3 * abs(np.mean(t)) + 1e-6 for t in tilt.values())
    again = {(r.doc_id, r.taken) for r in op8_entropy_mix(spark, SF01).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


def test_hot_source_nulls_repeats_clashing_columns(spark):
    rows = [(i, "w " * 5, "hot", "s") for i in range(2000)] + [(None, "a b", None, "k")] * 9 + [(7, None, "b", None), (8, "x " * 40_000, "b", None)]
    rows += [(5000 + i, "q " * (i % 50), "c", "z") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string").repartition(5)
    got = mix_counts(df).collect()
    assert len(got) == len(rows)
    size, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in got:
        size[r.source] += r["size"]
        taken[r.source] += r["size"] * r.copies
        largest[r.source] = max(largest[r.source], r["size"])
        assert 0 <= r.copies <= 2
    want = slow_targets(size)
    for s in size:
        assert abs(taken[s] - want[s]) <= largest[s] + 1
    mixed = mix(df)
    assert mixed.columns == df.columns
    assert sum(len((r.text or "").split()) for r in mixed.collect()) == sum(taken.values())
    assert mix_counts(df.limit(0)).count() == 0 and mix(df.limit(0)).count() == 0
    empty = spark.createDataFrame([(1, "", "a"), (2, None, "a")], "doc_id long, text string, source string")
    assert [r.target for r in mix_counts(empty).collect()] == [0.0, 0.0]
