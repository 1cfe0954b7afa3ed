"""Exact top-k search: tiled matrix products, partial selection per tile, tree merging of top lists."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.common import pick, stored, table
from tidecast.session import shared_path

TILE_QUERIES, TILE_ROWS = 512, 4096
LONG = np.iinfo(np.int64)


def _dense(vectors: pa.Array, scale: float) -> np.ndarray:
    """Rows floor(scale * x) as float64; shorter vectors are filled up with zeros."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    dim = int(lengths.max(initial=0))
    if len(flat) == dim * len(lengths):
        out = flat.reshape(len(lengths), dim)
    else:
        out = np.zeros((len(lengths), dim))
        out[np.arange(dim) < lengths[:, None]] = flat
    return np.floor(scale * out)


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in float64 while every sum stays under 2**53, in int64 under 2**63, else in
    Python's integers, then held within the range of a long."""
    dim = min(q.shape[1], c.shape[1])
    q, c = q[:, :dim], c[:, :dim]
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(dim, 1)
    if most < 2.0**53:
        return (q @ c.T).astype(np.int64)
    if most < 2.0**62:
        return q.astype(np.int64) @ c.astype(np.int64).T
    exact = np.vectorize(int, otypes=[object])
    return np.clip(exact(q).dot(exact(c).T) if q.size and c.size else np.zeros((len(q), len(c))), int(LONG.min), int(LONG.max)).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, real: np.ndarray, k: int):
    """Per row the k first by score, then by smaller id; ``real`` marks entries that exist."""
    order = np.lexsort((ids, ~scores, ~real), axis=-1)[:, :k]  # ~x falls as x rises and can't overflow
    return tuple(np.take_along_axis(x, order, 1) for x in (scores, ids, real))


def _tile(q, q_ids, c, c_ids, k: int):
    """The top lists of one tile. The candidates come in ascending order of id."""
    scores = _products(q, c)
    real = c_ids[None, :] != q_ids[:, None]
    if len(c_ids) > k + 1:
        scores[~real] = LONG.min
        least = np.partition(scores, len(c_ids) - k, axis=1)[:, len(c_ids) - k, None]
        over, level = scores > least, scores == least
        keep = over | level & (np.cumsum(level, axis=1) <= k - over.sum(1, keepdims=True))
        columns = np.nonzero(keep)[1].reshape(len(q), k)
        scores, real = np.take_along_axis(scores, columns, 1), np.take_along_axis(real, columns, 1)
        ids = c_ids[columns]
    else:
        ids = np.broadcast_to(c_ids, scores.shape)
    return _best(scores, ids, real, k)


def _search(batches, block, k: int, scale: float):
    """A partition's top lists for one block of queries, merged over its tiles."""
    q_ids, q = block.value
    top = (np.zeros((len(q_ids), 0), np.int64), np.zeros((len(q_ids), 0), np.int64), np.zeros((len(q_ids), 0), bool))
    for batch in batches if len(q_ids) else ():
        ids, vectors = batch["id"].to_numpy(), _dense(batch["v"], scale)
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        for a in range(0, len(ids), TILE_ROWS):
            part = []
            for b in range(0, len(q_ids), TILE_QUERIES):
                rows = slice(b, b + TILE_QUERIES)
                new = _tile(q[rows], q_ids[rows], vectors[a:a + TILE_ROWS], ids[a:a + TILE_ROWS], k)
                part.append(_best(*(np.concatenate([old[rows], x], axis=1) for old, x in zip(top, new)), k))
            top = tuple(np.concatenate(x) for x in zip(*part))
    scores, ids, real = top
    rows, columns = np.nonzero(real)
    yield pa.RecordBatch.from_arrays([pa.array(q_ids[rows]), pa.array(ids[rows, columns]), pa.array(scores[rows, columns])],
                                     ["query_id", "vec_id", "score"])


def _usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, v and a partition number; without null ids, null vectors and vectors with null or non-finite components."""
    rows = pick(vectors, id=id_col, v=vec_col).select(F.col("id").cast("long"), F.col("v").cast("array<double>"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad)


def merge_lists(lists: DataFrame, k: int, parts: int, fan_in: int = 32) -> DataFrame:
    """Tree merge of (query_id, part, vec_id, score): each round merges the lists of ``fan_in`` parts into one, so
    that no task ever holds all lists of a query at once."""
    for level in range(1, max(1, math.ceil(math.log(max(parts, 2), fan_in))) + 1):
        lists = lists.withColumn("part", F.floor(F.col("part") / fan_in).cast("int"))
        w = Window.partitionBy("query_id", "part").orderBy(F.desc("score"), "vec_id")
        lists = lists.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return lists.select("query_id", "rank", "vec_id", "score")


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
                vec_col: str = "embedding", scale: float = 1024.0, block_bytes: int = 32 << 20) -> DataFrame:
    """The k rows of ``vectors`` with the highest inner product with each row of ``queries``, its own id excepted.

    Components count as floor(scale * x). Result: query_id, rank (from 1), vec_id, score; equal scores go to the
    smaller id, a query with fewer than k candidates gets all of them.

    Queries travel in blocks of at most ``block_bytes`` (the bound of what is broadcast). For each block every
    partition multiplies its rows tile by tile, selects partially within the tile and merges into one list per
    query; the lists are stored and merged in a tree. Nothing depends on how rows are dealt out.

    Rows with a null id, a null vector or null, NaN or infinite components take no part, as query or candidate.
    Vectors shorter than others count as filled up with zeros; an empty one scores 0 with all. Rows that repeat an
    id are separate candidates (none of them for a query of that id); as queries the smallest vector of an id
    counts. Scores beyond a long's range are held at its ends. Empty tables give an empty result. Other columns
    are not read.
    """
    spark = vectors.sparkSession
    rows = _usable(vectors, id_col, vec_col)
    wanted = _usable(queries, id_col, vec_col).groupBy("id").agg(F.min("v").alias("v"))
    # one block is so many queries that its matrix stays within block_bytes; queries are numbered by their own order
    dim = max(1, wanted.agg(F.max(F.size("v"))).first()[0] or 1)
    per_block = max(1, block_bytes // (8 * dim))
    path = shared_path(spark, "top-lists")
    parts = max(1, rows.rdd.getNumPartitions())
    block, done = [], 0

    def run(block):
        ids = np.array([r[0] for r in block], np.int64)
        q = np.zeros((len(block), dim))
        for i, r in enumerate(block):
            q[i, :len(r[1])] = r[1]
        sent = spark.sparkContext.broadcast((ids, np.floor(scale * q)))
        found = rows.mapInArrow(lambda it: _search(it, sent, k, scale), "query_id long, vec_id long, score long")
        found.withColumn("part", F.spark_partition_id()).write.mode("append").parquet(path)
        sent.destroy()

    for row in wanted.toLocalIterator():
        block.append(row)
        if len(block) == per_block:
            run(block)
            block, done = [], done + 1
    if block or not done:
        run(block)
    return merge_lists(spark.read.parquet(path), k, parts)


def op1_exact_topk(spark, sf_dir: str) -> DataFrame:
    """All embeddings; queries: ids divisible by 100; ten best by the integer inner product of floor(1024 * x)."""
    rows = table(spark, sf_dir, "embeddings")
    return exact_top_k(rows, rows.filter(F.col("vec_id") % 100 == 0), k=10)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 10"""
