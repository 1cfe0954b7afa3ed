"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import cut


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """One star step over (a, b). Large: each node links its larger neighbours to the smallest one it knows; small:
    each node links its smaller neighbours and itself to the smallest one. The rows of a node are never brought into
    one list: its minimum is aggregated first and joined back."""
    if small:
        sided = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        sided = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = sided.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    joined = sided.join(least, sided.u == least.w)
    if small:
        linked = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("w"), "m"))
    else:
        linked = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return linked.filter("a <> b").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of the edge table (a, b), component being its smallest reachable node.

    Rounds of a large-star and a small-star step run until the edges no longer change, each round cut off by a
    checkpoint in the shared folder. Loops and repeated edges are allowed; edges with a null end are left out. An
    empty table gives an empty result. The number of rounds grows with the logarithm of the component's size;
    ``max_rounds`` only guards against an endless loop: reaching it raises an error.
    """
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    state = None
    for _ in range(max_rounds):
        new = cut(_stars(_stars(edges, small=False), small=True))
        # the same number of edges and the same sums of their ends' hashes: nothing moved
        now = tuple(new.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("sum(cast(xxhash64(b, a) as decimal(38,0)))")).first())
        edges = new
        if now == state or now[0] == 0:
            both = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            return both.union(edges.select("b", "b")).distinct()
        state = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
