"""Sharding over fixed virtual slots.

Records are hashed into thousands of virtual slots, whose number never changes. A slot-to-shard map places whole
slots; it is small, versioned and edited when shards are added or loads drift, so that a rebalance moves only the
slots it names. The bytes per slot are aggregated by Spark; only the map is handled on the driver.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecast.llm.common import exists, pick, ranked, stored, table
from tidecast.session import shared_path

SLOTS = 8192
#: A slot with over HOT times the mean of bytes is split into SPLITS parts, by a salt for each row.
HOT, SPLITS = 8, 64

MapRow = tuple[int, int, int, int]  # slot, part, shard, version that placed it there


def place(loads: dict[tuple[int, int], int], n_shards: int, version: int = 1) -> list[MapRow]:
    """A first map: slots in falling order of bytes, each to the shard with the fewest bytes so far."""
    heap = [(0, s) for s in range(n_shards)]
    out = []
    for (slot, part), size in sorted(loads.items(), key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        out.append((slot, part, shard, version))
        heapq.heappush(heap, (load + size, shard))
    return out


def rebalance(rows: list[MapRow], loads: dict[tuple[int, int], int], n_shards: int) -> list[MapRow]:
    """The next version of a map, for ``n_shards`` shards and the present bytes per slot.

    Slots move from the fullest shard to the emptiest as long as that evens out the two; while shards are added, only
    new shards take slots. Slots of shards that are no more, and slots that the map doesn't know yet, go to the
    emptiest. All other rows stay as they are.
    """
    version = max((r[3] for r in rows), default=0) + 1
    at = {(slot, part): (shard, v) for slot, part, shard, v in rows}
    held: dict[int, list] = {s: [] for s in range(n_shards)}
    total = defaultdict(int)
    lost = []
    for key in sorted({*at, *loads}):
        shard = at.get(key, (-1, 0))[0]
        if 0 <= shard < n_shards:
            held[shard].append((loads.get(key, 0), key))
            total[shard] += loads.get(key, 0)
        else:
            lost.append((loads.get(key, 0), key))
    known = {r[2] for r in rows}
    takers = [s for s in range(n_shards) if s not in known] or range(n_shards)
    emptiest = lambda among: min(among, key=lambda s: (total[s], s))

    def put(size, key, shard):
        held[shard].append((size, key))
        total[shard] += size
        at[key] = (shard, version)

    for size, key in sorted(lost, reverse=True):
        put(size, key, emptiest(range(n_shards)))
    while True:
        low, high = emptiest(takers), max(range(n_shards), key=lambda s: (total[s], -s))
        gap = total[high] - total[low]
        fitting = [x for x in held[high] if 0 < x[0] < gap]
        if not fitting:
            break
        size, key = min(fitting, key=lambda x: (abs(2 * x[0] - gap), x[1]))  # what leaves the two most alike
        held[high].remove((size, key))
        total[high] -= size
        put(size, key, low)
    return [(slot, part, *at[slot, part]) for slot, part in sorted(at)]


def store_map(spark: SparkSession, path: str, rows: list[MapRow], version: int) -> None:
    """Write a version of the map to the table at ``path``: all its rows, in a partition of its own. Versions that are
    there already stay readable; the same version written again (after a failure) replaces itself."""
    df = spark.createDataFrame(rows, "virtual_slot int, part int, shard int, map_version int").withColumn("version", F.lit(version))
    df.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(path)


def map_versions(spark: SparkSession, path: str) -> list[int]:
    """The versions of the map at ``path``, in ascending order."""
    return sorted(r["version"] for r in spark.read.parquet(path).select("version").distinct().collect())


def load_map(spark: SparkSession, path: str, version: int | None = None) -> list[MapRow]:
    """A stored version of the map, the last by default; as many rows as there are slots."""
    version = map_versions(spark, path)[-1] if version is None else version
    rows = spark.read.parquet(path).where(F.col("version") == version).select("virtual_slot", "part", "shard", "map_version").collect()
    if not rows:
        raise ValueError(f"there is no version {version} of the map at {path}")
    return sorted(map(tuple, rows))


def _records(docs: DataFrame, id_col: str, text_col: str, n_slots: int) -> DataFrame:
    """id, size, crc, virtual_slot and a row number of every row, stored: all that follows sees the same rows."""
    text = F.col("text")
    rows = pick(docs, id=id_col, text=text_col).withColumn("text", text.cast("string")).select(
        "id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("crc"), F.monotonically_increasing_id().alias("row"))
    return stored(rows.withColumn("virtual_slot", F.pmod(F.xxhash64("id", "crc", "size"), F.lit(n_slots)).cast("int")), "shard-records")


def shard_records(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                  n_slots: int = SLOTS, present: list[MapRow] | None = None, map_path: str | None = None) -> tuple[DataFrame, list[MapRow]]:
    """(rows, map): all rows of ``docs`` put into shards so that the shards' bytes are near equal.

    Rows: id_col, size (UTF-8 bytes of the text plus 1; a null text has none), text_crc32, virtual_slot, part, shard,
    position (its number within the shard, gapless from 0) and map_version. The map is a fresh one, or ``present``
    edited by ``rebalance``; its size is that of the slots, never of the rows. With ``map_path`` the last version stored there is edited (the first
    call makes version 1), the edited one is stored beside it and read back, and the rows are placed by what was read.

    A slot is the hash of id, text checksum and size. A slot far above the mean, as rows that repeat an id and a text
    many times make it, is split: its rows are dealt out in turn, in order of id, checksum and size, so that the split
    does not depend on the files' layout (rows alike in all three may change places). Null ids and texts hash like values; rows repeat as they do
    in the input; other columns are not read; an empty table gives no rows and a map without rows.
    """
    spark = docs.sparkSession
    stored_versions = map_versions(spark, map_path) if map_path and exists(spark, map_path) else []
    if stored_versions:
        present = load_map(spark, map_path)
    records = _records(docs, id_col, text_col, n_slots)
    by_slot = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    loads = by_slot.collect()  # at most n_slots rows
    mean = sum(r["bytes"] for r in loads) / n_slots
    hot = [r.virtual_slot for r in loads if r["bytes"] > HOT * mean and r["n"] > SPLITS]
    plain = records.withColumn("part", F.lit(0))
    salted = plain
    if hot:
        dealt = ranked(records.filter(F.col("virtual_slot").isin(hot)).withColumn("grp", F.col("virtual_slot").cast("string")),
                       ["grp", "id", "crc", "size"], "shard-hot")
        dealt = dealt.withColumn("part", F.pmod("pos", F.lit(SPLITS)).cast("int")).select(*plain.columns)
        salted = plain.filter(~F.col("virtual_slot").isin(hot)).unionByName(dealt)
    # with the split slots: fewer than n_slots * (1 + SPLITS / HOT) rows, as few slots can be HOT times the mean
    parts = {(r.virtual_slot, r.part): (r["bytes"], r["n"]) for r in salted.groupBy("virtual_slot", "part").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()} if hot else {(r.virtual_slot, 0): (r["bytes"], r["n"]) for r in loads}
    sizes = {k: v[0] for k, v in parts.items()}
    placed = rebalance(present, sizes, n_shards) if present else place(sizes, n_shards)
    if map_path and placed:
        version = (stored_versions or [0])[-1] + 1
        store_map(spark, map_path, placed, version)
        placed = load_map(spark, map_path, version)
    first, rows = defaultdict(int), []
    for slot, part, shard, version in placed:  # slots stand in a shard one after another
        rows.append((slot, part, shard, version, first[shard]))
        first[shard] += parts.get((slot, part), (0, 0))[1]
    where = spark.createDataFrame(rows, "virtual_slot int, part int, shard int, map_version int, first long")
    w = Window.partitionBy("virtual_slot", "part").orderBy("id", "crc", "row")
    out = salted.withColumn("at", F.row_number().over(w) - 1).join(F.broadcast(where), ["virtual_slot", "part"])
    return out.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "virtual_slot", "part", "shard",
                      (F.col("first") + F.col("at")).alias("position"), "map_version"), placed


def op4_slot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes; slot is the row's place within its shard."""
    rows, _ = shard_records(table(spark, sf_dir, "documents"), 16, map_path=shared_path(spark, "shard-map"))
    return rows.select("doc_id", "size", F.col("text_crc32").cast("long").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
                       F.col("position").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")
