"""Mixing sources to target weights by entropy balancing.

Among all document rates between 0 and ``most`` copies, entropy balancing takes those of the highest entropy that
meet each source's token target. They are exponential tilts of the documents' sizes: rate = most / (1 + exp(-l * x)),
x being the size over the source's mean size and l the source's multiplier, which solves a convex dual. Newton steps
for all sources at once are one aggregation each over the histogram of sizes.

Rates become whole copies by running sums: within a source documents stand from the largest to the smallest, and each
takes the whole numbers that the running sum of rates passes. The words taken then differ from the target by less
than one largest document (and the rounding of rates to 2**-24). Everything after the multipliers is done in whole
numbers, so that reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecast.llm.common import SPACES, as_text, pick_rows, row_key, stored, table

#: Rates are counted in parts of UNIT, so that running sums over 2**38 documents fit a long.
BITS = 24
UNIT = 1 << BITS
#: Rows of one source and size are ranked in so many parts, none of which can be large alone.
PARTS = 256


def targets(sizes: dict[str | None, int], weights=(5, 2, 1), share: float = 1.5, most: float = 2.0) -> dict[str | None, float]:
    """Targets by source: ``share`` of all sizes dealt out by weight (repeating in code point order, null last), held
    at ``most`` times the source's size; the excess goes to the others by weight until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, open_ = {}, set(order)
    left = share * sum(sizes.values())
    while open_:
        whole = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / whole > most * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / whole for s in open_}
        for s in over:
            out[s] = float(most * sizes[s])
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def _rate(l, x, most: float):
    """most / (1 + exp(-l x)), without overflow."""
    z = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), l * x))
    return F.lit(most) / (1 + F.exp(-z))


def multipliers(histogram: DataFrame, wanted: dict[int, float], sizes: dict[int, int], most: float = 2.0, rounds: int = 80) -> dict[int, float]:
    """The dual's solution by source number. ``histogram`` has (sid, size, x, n); a source whose target is 0 or all
    that it can give gets an infinite multiplier. Newton steps are kept within a shrinking bracket."""
    spark = histogram.sparkSession
    state = {}
    out = {}
    for s, t in wanted.items():
        if t >= most * sizes[s] * (1 - 1e-12) or t <= 0:
            out[s] = math.inf if t > 0 else -math.inf
        else:
            state[s] = [0.0, -math.inf, math.inf]
    for _ in range(rounds):
        if not state:
            break
        now = spark.createDataFrame([(s, v[0]) for s, v in state.items()], "sid int, l double")
        r = _rate(F.col("l"), F.col("x"), most)
        # sums of whole millionths are the same in any order
        micro = lambda c: F.sum(F.round(c * 1e6).cast("decimal(38,0)"))
        sums = (histogram.join(F.broadcast(now), "sid")
                .select("sid", (F.col("n") * F.col("size") * r).alias("g"), (F.col("n") * F.col("size") * F.col("x") * r * (1 - r / most)).alias("h"))
                .groupBy("sid").agg(micro(F.col("g")).alias("g"), micro(F.col("h")).alias("h")).collect())
        for row in sums:
            l, lo, hi = state[row.sid]
            gap, slope = wanted[row.sid] - float(row.g) / 1e6, float(row.h) / 1e6
            if abs(gap) <= 1e-9 * wanted[row.sid] or hi - lo < 1e-13 * max(1.0, abs(l)):
                out[row.sid] = l
                del state[row.sid]
                continue
            lo, hi = (l, hi) if gap > 0 else (lo, l)
            step = l + gap / slope if slope > 0 else math.nan
            if not lo < step < hi:  # outside of the bracket, or no slope: halve it, or widen it twofold
                step = (lo + hi) / 2 if math.isfinite(lo + hi) else 2 * l + 1 if gap > 0 else 2 * l - 1
            state[row.sid] = [step, lo, hi]
    return out | {s: v[0] for s, v in state.items()}


def mix_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights=(5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """One row per input row: id, key (hash of the whole row), source, size (words), source_size, target, rate, copies.

    A source's copies times sizes come within one largest document of its target. No row gets more than ``most``
    copies; a row without words gets ``most / 2`` on average, as it doesn't matter to the target. Sources and targets
    pass through the driver, one row per source.

    A null text has no words; null sources form one source, standing last; null ids rank first; repeated rows are
    separate documents; other columns only enter the key. Without any word all targets are 0; an empty table gives an
    empty result. Reruns give the same copies for the same rows.
    """
    spark = docs.sparkSession
    words = F.size(F.filter(F.split(as_text(docs[text_col]), f"[{SPACES}]+"), lambda w: w != ""))
    rows = stored(docs.select(docs[id_col].alias("id"), row_key(docs).alias("key"), docs[source_col].cast("string").alias("source"),
                              words.cast("long").alias("size")), "mix-rows")
    found = rows.groupBy("source").agg(F.sum("size").alias("size"), F.sum((F.col("size") > 0).cast("long")).alias("n")).collect()
    size = {r.source: r["size"] for r in found}
    target = targets(size, weights, share, most)
    order = sorted(size, key=lambda s: (s is None, s or ""))
    mean = {r.source: r["size"] / max(r["n"], 1) or 1.0 for r in found}
    names = spark.createDataFrame([(s, i, size[s], float(target[s]), float(mean[s])) for i, s in enumerate(order)],
                                  "name string, sid int, source_size long, target double, mean double")
    numbered = rows.join(F.broadcast(names), rows.source.eqNullSafe(names.name)).drop("name")
    histogram = stored(numbered.groupBy("sid", "size", "mean").agg(F.count("*").alias("n"))
                       .select("sid", "size", (F.col("size") / F.col("mean")).alias("x"), "n"), "mix-sizes")
    found = multipliers(histogram, {i: target[s] for i, s in enumerate(order)}, {i: size[s] for i, s in enumerate(order)}, most)
    solved = spark.createDataFrame([(i, float(f"{l:.10g}")) for i, l in found.items()], "sid int, l double")
    # rates in whole units, and the running sum of rates before each size, from the largest down: over bands of sizes
    # first, then within a band, so that no window holds a whole source
    rate = F.when(F.col("l") == float("inf"), F.lit(float(most))).when(F.col("l") == float("-inf"), F.lit(0.0)).otherwise(_rate(F.col("l"), F.col("x"), most))
    rated = histogram.join(F.broadcast(solved), "sid").select(
        "sid", "size", "n", F.round(rate * UNIT).cast("long").alias("unit"), F.floor(F.log2(F.col("size") + 1) * 8).cast("int").alias("band"))
    band = rated.groupBy("sid", "band").agg(F.sum(F.col("n") * F.col("unit")).alias("sum"))
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    band = band.select("sid", "band", F.coalesce(F.sum("sum").over(before("sid").orderBy(F.desc("band"))), F.lit(0)).alias("above"))
    start = rated.join(band, ["sid", "band"]).select("sid", "size", "unit", (F.col("above") + F.coalesce(F.sum(
        F.col("n") * F.col("unit")).over(before("sid", "band").orderBy(F.desc("size"))), F.lit(0))).alias("start"))
    # within one size, rows are ranked in parts by the hash of id and key
    dealt = numbered.withColumn("part", F.pmod(F.xxhash64("id", "key"), F.lit(PARTS)))
    part = dealt.groupBy("sid", "size", "part").agg(F.count("*").alias("n")).select(
        "sid", "size", "part", F.coalesce(F.sum("n").over(before("sid", "size").orderBy("part")), F.lit(0)).alias("rank0"))
    first = part.join(start, ["sid", "size"]).select("sid", "size", "part", "unit", (F.col("start") + F.col("rank0") * F.col("unit") + UNIT // 2).alias("first"))
    ranked = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("sid", "size", "part").orderBy("id", "key")))
    upto = lambda r: F.shiftright(F.col("first") + F.col("unit") * r, BITS)
    return ranked.join(first, ["sid", "size", "part"]).select(
        "id", "key", "source", "size", "source_size", "target", (F.col("unit") / UNIT).alias("rate"),
        (upto(F.col("rank")) - upto(F.col("rank") - 1)).alias("copies"))


def mix(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` mixed: each row as often as ``mix_counts`` says, with all its columns."""
    chosen = mix_counts(docs, **settings).groupBy("id", "key").agg(F.sum("copies").alias("copies"), F.count("*").alias("alike"))
    return pick_rows(docs, chosen.filter("copies > 0"), settings.get("id_col", "doc_id"))


def op8_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mix_counts(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"),
                       "rate", F.col("copies").cast("long").alias("copies"))
