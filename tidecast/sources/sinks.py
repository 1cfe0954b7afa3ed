"""Sinks: clustered tables, predictions (S9) and fitted models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidecast.operators._chunks import as_list
from tidecast.session import shared_path


def write_clustered(df: DataFrame, path: str, by: Sequence[str] = ("symbol",), order: Sequence[str] = ("date",),
                    partition_by: Sequence[str] = (), mode: str = "overwrite", fmt: str = "parquet") -> str:
    """Write ``df`` clustered by ``by`` (range-partitioned, sorted within files by ``by`` + ``order``).

    Readers that filter on the key then skip row groups by their min/max
    statistics. A directory per value (``partition_by``) suits only keys with
    few values: one directory per symbol of thousands makes thousands of tiny
    files. The file count follows the shuffle partitions, coalesced by AQE.
    """
    by = [b for b in by if b in df.columns]
    order = [o for o in order if o in df.columns]
    out = df.repartitionByRange(*by).sortWithinPartitions(*by, *order) if by else df
    w = out.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def write_predictions(df: DataFrame, path: str, by: str | None = "symbol", mode: str = "overwrite",
                      fmt: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    """Write a predictions frame clustered by ``by`` so readers skip on it."""
    return write_clustered(df, path, by=[by] if by else [], order=("idx", "date"), partition_by=partition_by,
                           mode=mode, fmt=fmt)


def save_model(model, path: str) -> str:
    """Persist a fitted MLlib model or pipeline."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    """Reload a model saved by :func:`save_model` (pipeline models)."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def write_bucketed(df: DataFrame, name: str, by, order=(), buckets: int = 64) -> str:
    """Save ``df`` as a table bucketed by ``by`` and sorted by (``by``, ``order``) within its buckets, under the shared folder;
    returns the table's name, which is made unique. Windows, groups and joins by ``by`` over ``spark.table(name)`` need no
    exchange of its rows, whatever they are and how often they are asked for. Each bucket is one file."""
    spark, by = df.sparkSession, as_list(by)
    path = shared_path(spark, name)
    table = f"{name}_{path.rsplit('-', 1)[-1]}"
    writer = df.repartition(buckets, *by).write.bucketBy(buckets, by[0], *by[1:]).sortBy(by[0], *by[1:], *as_list(order))
    writer.option("path", path).format("parquet").saveAsTable(table)
    return table
