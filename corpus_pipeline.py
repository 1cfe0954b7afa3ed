"""The corpus pipeline: quality rules, SimHash near-dedup, mixing to target weights, BPE encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes a stage's rows as Parquet and reads
them again as the next stage's documents. All stages but the last return the columns of their documents.

Null ids, repeated rows, extra columns, empty tables: as in the operators that the stages call. Rows that are alike
in all columns may stand for each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidecast.llm import bpe, mixing, quality, simhash
from tidecast.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality rule go."""
    return quality.keep_clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash neighbours (three-word shingles, two bits) the document with the smallest id stays."""
    return simhash.one_per_component(docs, words=3, max_bits=2)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights; a document stands in the result as often as the mix takes it."""
    return mixing.mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE ids and decoded texts, as digests: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return bpe.digests(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("mixing_to_targets", mixing_weights),
    ("bpe_encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Multi-index hashing, entropy balancing and BPE have no SQL form.
ORACLE_SQL = None
