"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecast.session import ensure_checkpoint_dir, shared_path

#: Bytes that separate words in the contracts: space and 0x09 to 0x0D, the set that ``bytes.split()`` uses.
SPACES = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns) -> DataFrame:
    """The given columns under new names: ``pick(df, id="doc_id")``; other columns, whatever their names, go."""
    return df.select(*[df[old].alias(new) for new, old in columns.items()])


def as_text(col):
    """The column as a string; null counts as the empty text."""
    return F.coalesce(col.cast("string"), F.lit(""))


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the folder of spark.checkpoint.dir and read back: its lineage ends there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the folder of spark.checkpoint.dir."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, in whatever store Spark finds it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def row_key(docs: DataFrame):
    """A hash of all columns: rows that agree in it and in their id are alike, whichever of them is taken."""
    return F.xxhash64(*[docs[f"`{c}`"] for c in docs.columns])


def pick_rows(docs: DataFrame, chosen: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that ``chosen`` names, ``copies`` times, with all their columns. ``chosen`` has (id, key,
    copies, alike), once for each id and key; of ``alike`` rows that share them one is taken."""
    named = chosen.select(F.col("id").alias("_id"), F.col("key").alias("_key"), F.col("copies").alias("_copies"), F.col("alike").alias("_alike"))
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # no column's name can clash with ours
    keyed = plain.withColumn("_row", row_key(plain))
    at = f"c{docs.columns.index(id_col)}"
    met = keyed.join(named, F.col(at).eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_key")))
    single, alike = met.filter("_alike = 1"), met.filter("_alike > 1").dropDuplicates([at, "_row"])
    out = single.union(alike).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return out.select(*[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


def ranked(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` (with a column ``grp``, by which ``order`` begins) with ``pos``, the place of each row within its group, and
    ``n``, the group's rows. Rows are dealt by ranges of ``order``; a place is the place within the range plus the rows
    of the ranges before, so that no group has to fit one task. Stored twice: ranges are cut from written rows, and all
    that follows sees one numbering."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a row's own number in the key lets ranges be cut also among rows that are alike
    rows = stored(df.withColumn("_row", F.monotonically_increasing_id()), f"{name}-rows")
    rows = rows.repartitionByRange(parts, *[F.col(c).asc_nulls_first() for c in order], "_row")
    rows = rows.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order], "_row").drop("_row")
    placed = stored(rows.withColumn("_at", F.monotonically_increasing_id()), f"{name}-ranges")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    runs = placed.groupBy("grp", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    w = Window.partitionBy("grp")  # one row per group and range
    before = F.coalesce(F.sum("_n").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("grp", "_part", "_first", before.alias("_before"), F.sum("_n").over(w).alias("n"))
    out = placed.join(runs, ["grp", "_part"]).withColumn("pos", F.col("_before") + F.col("_at") - F.col("_first"))
    return out.select(*[c for c in df.columns], "pos", "n")


def sha256(data) -> str:
    return hashlib.sha256(data).hexdigest()
