"""The Merkle manifest against a plain recomputation, its proofs, and unusual rows."""

import zlib
from collections import defaultdict
from hashlib import sha256

import pyarrow.parquet as pq
import pytest

from tidecast.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in row])


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def way(levels, i):
    """(own place, siblings) level by level."""
    out = []
    for level in levels[:-1]:
        run = level[i // 8 * 8:i // 8 * 8 + 8]
        out.append((i % 8, run[:i % 8] + run[i % 8 + 1:]))
        i //= 8
    return out


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = tree([leaf(r) for r in groups[g]])
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            path = way(trees[g], i) + way(top, k)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            node = leaf((*r[:4], r[4] and r[4].translate(LOW))) if hit else leaf(r)
            for own, others in path:
                node = h(*others[:own], node, *others[own:])
            root = top[-1][0]
            out.append((r[0], leaf(r), trees[g][-1][0], root, h(*[x for _, o in path for x in o]), node, node == root))
    return sorted(out, key=str)


def run(spark, rows, tmp_path, extra="", levels=merkle.LEVELS):
    spark.createDataFrame([tuple(r) + ((1, "x") if extra else ()) for r in rows], SCHEMA + extra).write.parquet(f"{tmp_path}/documents.parquet")
    got = merkle.op12_merkle_manifest(spark, str(tmp_path), levels)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_matches_a_plain_recomputation(spark, tmp_path, levels):
    rows = [(i, f"s{i % 3}", "en" if i % 3 else "fr", i, f"Text {i}") for i in range(230)]
    rows += [(1000, None, None, None, None), (1001, "", "", 0, ""), (1002, "s", "é", 1, "ABC" * 100_000)]
    rows += [(5000 + i, "s", "de", 1, "a") for i in range(8)] + [(6000 + i, "s", "es", 1, "B") for i in range(9)]
    rows += [(i, "s", f"x{i}", 1, "t") for i in range(70)]  # more groups than one level of the upper tree takes
    assert run(spark, rows, tmp_path, levels=levels) == expected(rows)


def test_repeated_rows_null_ids_ties_and_clashing_columns(spark, tmp_path):
    rows = [(7, "s", "en", 1, "A")] * 20 + [(7, "s", "en", 1, "B"), (None, "s", "en", 1, "C"), (None, None, None, None, None)]
    assert run(spark, rows, tmp_path, extra=", n long, hash string") == expected(rows)


def test_one_row_and_no_row(spark, tmp_path):
    row = (3, "s", None, 2, "aB")
    got = run(spark, [row], tmp_path / "one")
    assert got == expected([row]) and got[0][2] == got[0][3] == got[0][1] and got[0][4] == h()
    assert run(spark, [], tmp_path / "none") == []


def test_sf_table_and_its_proofs(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r.values()) for r in pq.read_table(f"{d}/documents.parquet", columns=["doc_id", "source", "lang", "n_chars", "text"]).to_pylist()]
    got = sorted(map(tuple, merkle.op12_merkle_manifest(spark, d).collect()), key=str)
    assert got == expected(rows)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for r in merkle.manifest(docs, ["doc_id", "text"]).limit(50).collect():
        assert merkle.fold(r.leaf, r.way) == r.root and merkle.fold(merkle._h([r.leaf]), r.way) != r.root
