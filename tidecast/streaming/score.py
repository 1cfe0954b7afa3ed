"""Score newly arrived bars with a fitted model.

Stateless: a file source with an explicit schema, a stream-static join with
the per-key coefficient table (or an MLlib model's ``transform``), and an
idempotent file sink. The checkpoint lives in the shared checkpoint folder, so
a restarted or re-tried query resumes exactly where it stopped.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidecast.operators._chunks import as_list
from tidecast.operators.models import predict_grouped_linear
from tidecast.session import shared_path


def score_stream(spark: SparkSession, source_dir: str, schema: T.StructType, features: Sequence[str],
                 coefs: DataFrame | None = None, model=None, by=("symbol",), sink_dir: str | None = None,
                 keep: Sequence[str] | None = None, available_now: bool = True,
                 checkpoint_dir: str | None = None) -> tuple[str, object]:
    """Start a stream from ``source_dir`` to ``sink_dir`` (parquet); returns (sink_dir, query).

    The checkpoint is stable per sink (``<sink_dir>/_checkpoint`` unless
    given; readers skip ``_``-prefixed folders), so running the query again
    after a failure or on a schedule processes only files that arrived since,
    exactly once. Without ``sink_dir`` a fresh folder in the shared checkpoint
    folder is used. With ``available_now`` the query processes what has
    arrived and stops; otherwise it keeps running.
    """
    by = as_list(by)
    stream = spark.readStream.schema(schema).parquet(source_dir)
    if coefs is not None:
        scored = predict_grouped_linear(coefs, stream, features, by)
    elif model is not None:
        scored = model.transform(stream).drop("features")
    else:
        raise ValueError("give coefs or model")
    if keep is not None:
        scored = scored.select(*keep, "prediction")
    if sink_dir is None:
        base = shared_path(spark, "scored")
        sink_dir = os.path.join(base, "data")
        checkpoint_dir = checkpoint_dir or os.path.join(base, "_checkpoint")
    checkpoint_dir = checkpoint_dir or os.path.join(sink_dir, "_checkpoint")
    writer = scored.writeStream.format("parquet").option("path", sink_dir) \
        .option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return sink_dir, q
