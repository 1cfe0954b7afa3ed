"""SimHash near-duplicates against brute force."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SF001
from tidecast.llm.components import connected_components
from tidecast.llm.simhash import fingerprint, links, op5_simhash_components, radii, simhash_components


def slow_fingerprint(text):
    words = (text or "").translate({i: i + 32 for i in range(65, 91)}).encode().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps, max_bits):
    parent = list(range(len(fps)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                parent[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(fps))]


def signed(x):
    return int(np.array(x, np.uint64).view(np.int64))


def test_fingerprint():
    for t in ["", "a", "A b", "a b c d", "x  y\tz\nw \x0b q", "é Ä b c", "word " * 300, "a b", "\x1c a b c"]:
        assert fingerprint(t.encode()) == slow_fingerprint(t)


def test_same_hash_as_spark(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b é"))).first()
    assert row[0] == signed(xxhash.xxh64_intdigest("a b é".encode(), 42))


def test_radii():
    assert radii(2, 2) == [1, 0] and radii(2, 4) == [0, 0, 0, -1] and radii(3, 2) == [1, 1] and radii(1, 1) == [1]


@pytest.mark.parametrize("max_bits,bucket_rows", [(2, 16), (2, 0), (2, 3), (1, 2), (3, 1), (0, 4)])
def test_links_join_all_neighbours(spark, max_bits, bucket_rows):
    rng = np.random.default_rng(max_bits)
    base = [int(x) for x in rng.integers(0, 2**63, 25)]
    fps = set(base)
    for b in base[:8]:  # clusters and chains
        for _ in range(12):
            f = b
            for bit in rng.integers(0, 64, rng.integers(1, 6)):
                f ^= 1 << int(bit)
            fps.add(f)
    fps |= {0, 1, 3, 7, 15}
    fps = sorted(fps)
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    if max_bits == 3:
        df = df.limit(60)
        fps = sorted(r.fp % 2**64 for r in df.collect())
    found = links(df, max_bits, bucket_rows=bucket_rows)
    pairs = found.collect()
    assert all(((r.a ^ r.b) % 2**64).bit_count() <= max_bits for r in pairs)
    comp = {r.node: r.component for r in connected_components(found).collect()}
    want = slow_components(fps, max_bits)
    groups = {}
    for f, w in zip(fps, want):
        groups.setdefault(w, set()).add(comp.get(signed(f), signed(f)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(400, 600)] + [(1, 1), (2, None)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = sorted({x for e in edges for x in e if None not in e and e[0] != e[1]})
    assert set(got) == set(nodes)
    near = {n: set() for n in nodes}
    for a, b in edges:
        if b is not None and a != b:
            near[a].add(b)
            near[b].add(a)
    for n in nodes:
        seen, todo = {n}, [n]
        while todo:
            for m in near[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        assert got[n] == min(seen)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query(spark):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    fps = [slow_fingerprint(r.text) for r in rows]
    top = slow_components(fps, 2)
    want = {(r.doc_id, f"{f:016x}", rows[t].doc_id) for r, f, t in zip(rows, fps, top)}
    assert {tuple(r) for r in op5_simhash_components(spark, SF001).collect()} == want


def test_nulls_repeats_clashing_columns(spark):
    rows = [(5, None, 1, "z"), (3, "", 2, "z"), (None, "  ", 3, None), (7, "a b c d e f", 1, ""), (7, "a b c d e f", 1, ""),
            (None, "only here twice", 1, ""), (8, "x " * 100_000, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int, component string")
    got = sorted(str((r.doc_id, r.component_id)) for r in simhash_components(df).collect())
    assert got == sorted(map(str, [(5, 3), (3, 3), (None, 3), (7, 7), (7, 7), (None, None), (8, 8)]))
    assert simhash_components(df.limit(0)).count() == 0
