"""A Merkle manifest of a dataset: a tree over the rows of each group, a tree over the groups, a proof for every row.

Nodes of a layer are cut into superblocks of ``WIDTH ** levels`` consecutive ones. A superblock is reduced to one node by
itself, and these nodes are the next layer's, until each group has one node left; the groups' nodes then go through
the same layers as one group. On the way back each layer's nodes are cogrouped by superblock with the nodes of the
layer above, which carry the siblings on their way to the root ("outer" nodes): the local reduction, the proof and
the folding of the proof happen in that one task. No task sees more than one superblock and its outer nodes, however
many rows a group has.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm.common import pick, ranked, stored, table

#: Fixed value of the contract: so many consecutive nodes become one.
WIDTH = 8
#: Levels that one superblock reduces by default: 8 ** 4 = 4,096 nodes.
LEVELS = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NODE = "grp string, pos long, n long, hash string"


def _field(col):
    """``-`` for null, else the number of UTF-8 bytes, a colon, and the value (integers in decimal)."""
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(*cols):
    return F.sha2(F.concat(*[_field(c) for c in cols]), 256)


def _h(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def _levels(n: int, most: int) -> int:
    """Levels that a superblock of a layer with n nodes in the group reduces: all that are left, ``most`` at most."""
    depth = 0
    while WIDTH ** depth < n and depth < most:
        depth += 1
    return depth


def _reduce(hashes: list[str], depth: int) -> list[list[str]]:
    """The nodes of a superblock level by level: ``depth`` times every WIDTH consecutive ones become one."""
    tree = [hashes]
    for _ in range(depth):
        last = tree[-1]
        tree.append([_h(last[i:i + WIDTH]) for i in range(0, len(last), WIDTH)])
    return tree


def _block_of(t: pa.Table, levels: int):
    """A superblock's rows in order of place: (order, hashes, depth)."""
    order = np.argsort(t["pos"].to_numpy())
    hashes = t["hash"].take(pa.array(order)).to_pylist()
    return order, hashes, _levels(t["n"][0].as_py(), levels)


def _roots(t: pa.Table, levels: int) -> pa.Table:
    _, hashes, depth = _block_of(t, levels)
    size = WIDTH ** levels
    return pa.table({"grp": t["grp"].slice(0, 1), "pos": pa.array([t["block"][0].as_py()], pa.int64()),
                     "n": pa.array([-(-t["n"][0].as_py() // size)], pa.int64()), "hash": [_reduce(hashes, depth)[-1][0]]})


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {WIDTH ** levels}"))


def _climb(nodes: DataFrame, name: str, levels: int) -> list[DataFrame]:
    """The layers from ``nodes`` to that of one node a group, each stored."""
    layers = [nodes]
    while (layers[-1].agg(F.max("n")).first()[0] or 0) > 1:
        blocks = _blocks(layers[-1].select("grp", "pos", "n", "hash"), levels)
        up = blocks.groupBy("grp", "block").applyInArrow(lambda t: _roots(t, levels), NODE)
        layers.append(stored(up, f"{name}-layer"))
    return layers


# A way to the root is text: for each level ``index:hash,hash,...`` with the run's nodes but the own one, joined by ";".


def _ways(t: pa.Table, outer: pa.Table, levels: int):
    """(order, hashes, ways from each node to the root) of a superblock, whose outer nodes are one row of ``outer``."""
    order, hashes, depth = _block_of(t, levels)
    tree = _reduce(hashes, depth)
    above = outer["way"][0].as_py()
    runs = [[level[i:i + WIDTH] for i in range(0, len(level), WIDTH)] for level in tree[:depth]]
    ways = []
    for i in range(len(hashes)):
        way, at = [], i
        for level in runs:
            at, own = divmod(at, WIDTH)
            run = level[at]
            way.append(f"{own}:{','.join(run[:own] + run[own + 1:])}")
        ways.append(";".join([*way, above] if above else way))
    return order, hashes, ways


def _descend(t: pa.Table, outer: pa.Table, levels: int) -> pa.Table:
    order, hashes, ways = _ways(t, outer, levels)
    t = t.take(pa.array(order))
    same = lambda c: pa.array([outer[c][0].as_py()] * len(ways), pa.string())
    # the last node of a group's tree is the group's own root
    return pa.table({"grp": t["grp"], "pos": t["pos"], "way": ways, "subroot": same("subroot"), "root": same("root")})


def _with_ways(layers: list[DataFrame], top: DataFrame, levels: int) -> DataFrame:
    """The ways of the second layer's nodes (the last's, if it is the only one), ``top`` having those of the last."""
    for nodes in reversed(layers[1:-1]):
        below = _blocks(nodes.select("grp", "pos", "n", "hash"), levels)
        top = below.groupBy("grp", "block").cogroup(top.withColumn("block", F.col("pos")).groupBy("grp", "block")).applyInArrow(
            lambda t, o: _descend(t, o, levels), "grp string, pos long, way string, subroot string, root string")
    return top


def fold(leaf: str, way: str) -> str:
    """The root that a leaf and the siblings on its way give."""
    for level in way.split(";") if way else ():
        own, _, rest = level.partition(":")
        run = rest.split(",") if rest else []
        run.insert(int(own), leaf)
        leaf = _h(run)
    return leaf


def siblings(way: str) -> list[str]:
    """All siblings on a way, level by level, left to right."""
    return [h for level in way.split(";") if way for h in level.partition(":")[2].split(",") if h]


_PROOF = "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _prove(t: pa.Table, outer: pa.Table, with_way: bool, levels: int) -> pa.Table:
    order, hashes, ways = _ways(t, outer, levels)
    ids, tampered = (t[c].take(pa.array(order)).to_pylist() for c in ("id", "tampered"))
    subroot, root = outer["subroot"][0].as_py(), outer["root"][0].as_py()
    folded = [fold(h if other is None else other, way) for h, other, way in zip(hashes, tampered, ways)]
    n = len(ids)
    out = {"id": pa.array(ids, pa.int64()), "leaf": hashes, "subroot": [subroot] * n, "root": [root] * n,
           "proof_sha256": [_h(siblings(way)) for way in ways], "folded_root": folded, "verified": [f == root for f in folded]}
    if with_way:
        out["way"] = ways
    return pa.table(out)


def manifest(docs: DataFrame, fields: list[str], group: str = "lang", id_col: str = "doc_id", tampered=None,
             with_way: bool = True, levels: int = LEVELS) -> DataFrame:
    """A Merkle tree over all rows, with a proof for each: id_col, leaf, subroot (of the row's group), root, proof_sha256,
    folded_root, verified and, ``with_way``, the proof itself (``fold(leaf, way)`` gives the root).

    A leaf is the hash of ``fields``; ``tampered``, a column over ``docs``, is a leaf to fold instead wherever it is not
    null. Groups are ordered by name, null first; a group's rows by id, null first, rows of one id by leaf (rows that
    have both in common may change places, which changes nothing but which of them has which proof). Null values have
    a sign of their own, so that null and the empty text give different leaves. A row alone in its group is its group's root; a group
    alone is the root; then the proof is the hash of nothing. Very long texts are hashed where they are read and never
    shuffled. Other columns aren't read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    leaves = docs.select(docs[id_col].cast("long").alias("id"), docs[group].cast("string").alias("name"),
                         _field(docs[group]).alias("grp"), _leaf(*[docs[c] for c in fields]).alias("hash"),
                         (F.lit(None).cast("string") if tampered is None else tampered).alias("tampered"))
    leaves = stored(ranked(leaves, ["grp", "id", "hash"], "merkle-leaves"), "merkle-leaves")
    layers = _climb(leaves, "merkle", levels)
    names = leaves.select("grp", "name").distinct()
    # the groups' nodes as the leaves of one group
    groups = layers[-1].select("grp", "hash").join(names, "grp").select(F.lit("").alias("grp"), "name", F.col("grp").alias("of"), "hash")
    groups = stored(ranked(groups, ["grp", "name"], "merkle-groups"), "merkle-groups")
    upper = _climb(groups, "merkle-upper", levels)
    top = upper[-1].select("grp", "pos", F.lit("").alias("way"), F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"))
    top = _with_ways([None, *upper], top, levels)
    top = groups.select("pos", F.col("of"), "hash").join(top.drop("grp", "subroot"), "pos").select(
        F.col("of").alias("grp"), F.lit(0).cast("long").alias("pos"), "way", F.col("hash").alias("subroot"), "root")
    top = stored(top, "merkle-top")
    top = _with_ways(layers, top, levels)
    below, over = _blocks(leaves, levels), top.withColumn("block", F.col("pos"))
    schema = _PROOF + (", way string" if with_way else "")
    out = below.groupBy("grp", "block").cogroup(over.groupBy("grp", "block")).applyInArrow(lambda t, o: _prove(t, o, with_way, levels), schema)
    return out.withColumnRenamed("id", id_col)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str, levels: int = LEVELS) -> DataFrame:
    """All documents; where 3 divides crc32(doc_id), the folded leaf is that of the text with A-Z in lower case."""
    docs = table(spark, sf_dir, "documents")
    docs = pick(docs, doc_id="doc_id", source="source", lang="lang", n_chars="n_chars", text="text")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    low = F.translate(F.col("text"), _UPPER, _LOWER)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = F.when(hit, _leaf(*[F.col(c) for c in fields[:-1]], low))
    return manifest(docs, fields, tampered=tampered, with_way=False, levels=levels)
