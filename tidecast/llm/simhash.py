"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint has a bit for each bit position that is set in over half of its shingles' hashes. Fingerprints
within ``max_bits`` differing bits are linked; a text's component is all that links reach.

Only distinct fingerprints are compared. They are cut into segments; by the pigeonhole principle two fingerprints
within the distance differ by no more than a segment's radius in at least one segment. Every fingerprint is filed
under its segments' values, and looks up the small Hamming ball around each segment's value; each match is verified
over all 64 bits. A segment value with more than ``bucket_rows`` fingerprints would give pairs by their square, so
fingerprints that are filed under or look up such a value go another, equally exact way: two fingerprints within
``max_bits`` always share a point in the balls of radius ``(max_bits + 1) // 2`` around both. They are grouped by
these points, segment by segment flipped, and each is compared with few others of its group only (see _hot_links).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import as_text, cut, pick_rows, row_key, table
from tidecast.llm.components import connected_components

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of one text, as an unsigned number; 0 without words."""
    return int(_fingerprints([text], words, seed)[0])


def _shingle_hashes(text: bytes, words: int, seed: int) -> np.ndarray:
    found = text.translate(_LOWER).split()
    line = b" ".join(found)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(line, seed)] if found else [], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = [0, *ends[: len(found) - words].tolist()]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], seed) for a, b in zip(starts, (ends[words - 1:] - 1).tolist())], np.uint64)


#: So many hashes at a time are spread into bits, which bounds the memory for very long texts.
SPREAD = 1 << 16


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    total = np.zeros(64, np.int64)
    for a in range(0, len(hashes), SPREAD):
        some = hashes[a:a + SPREAD].astype("<u8")
        total += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return total


def _fingerprints(texts, words: int, seed: int) -> np.ndarray:
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    out = np.zeros(len(texts), np.uint64)
    for i, text in enumerate(texts):
        hashes = _shingle_hashes(text, words, seed)
        if len(hashes):
            out[i] = weights[2 * _bit_counts(hashes) > len(hashes)].sum(dtype=np.uint64)
    return out


def _batches(it, words: int, seed: int):
    for batch in it:
        bits = _fingerprints([t.as_py() for t in batch["text"].cast(pa.binary())], words, seed)
        rest = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(batch[n] for n in rest), pa.array(bits.view(np.int64))], [*rest, "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = 42, keyed: bool = False) -> DataFrame:
    """(id, fp): each row's id and SimHash, as a signed long. A null text has no words: fingerprint 0. ``keyed`` adds
    ``key``, a hash of the whole row."""
    key = [row_key(docs).alias("key")] * keyed
    rows = docs.select(docs[id_col].cast("long").alias("id"), *key, as_text(docs[text_col]).alias("text"))
    return rows.mapInArrow(lambda it: _batches(it, words, seed), "id long, " + "key long, " * keyed + "fp long")


def segments(n: int, bits: int = 64) -> list[tuple[int, int]]:
    """(shift, width) of n segments of near equal width."""
    cuts = [bits * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def radii(max_bits: int, n: int) -> list[int]:
    """Radii per segment so that two fingerprints within max_bits meet in some segment: they add up to
    max_bits - n + 1, so exceeding each of them takes more than max_bits differing bits. -1: segment not needed."""
    total = max_bits - n + 1
    if total < 0:
        return [0] * (max_bits + 1) + [-1] * (n - max_bits - 1)
    return [total // n + (i < total % n) for i in range(n)]


def _ball(width: int, radius: int, shift: int = 0) -> list[int]:
    """All masks with up to ``radius`` set bits within a segment, as signed longs."""
    return [int(np.array(sum(1 << (shift + b) for b in c), np.uint64).view(np.int64))
            for r in range(radius + 1) for c in combinations(range(width), r)]


def _masks(values: list[int]):
    return F.array(*[F.lit(v).cast("long") for v in values])


def _distance(a, b):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _hot_links(hot: DataFrame, max_bits: int, n_segments: int) -> DataFrame:
    """Links between fingerprints that meet in a crowded segment value.

    Each fingerprint enumerates the points within radius (max_bits + 1) // 2, as flips inside its segments; two
    fingerprints within max_bits share such a point. A point's group can't be large: it is part of one ball. For even
    max_bits any two of a group are within max_bits, so that linking each to the group's smallest loses no link. For
    odd max_bits two of a group may be one bit too far, so that all pairs of the (bounded) group are verified.
    """
    radius = (max_bits + 1) // 2
    flips = [0]
    for shift, width in segments(n_segments):  # combine the segments' balls, keeping to the radius over all
        ball = _ball(width, radius, shift)
        flips = [a | b for a in flips for b in ball if (a & (2**64 - 1)).bit_count() + (b & (2**64 - 1)).bit_count() <= radius]
    points = hot.select(F.explode(F.transform(_masks(flips), lambda m: m.bitwiseXOR(F.col("fp")))).alias("point"), "fp")
    if max_bits % 2 == 0:
        least = points.groupBy("point").agg(F.min("fp").alias("b"), F.max("fp").alias("c")).filter("b < c")
        met = points.join(least, "point").select(F.col("fp").alias("a"), "b")
    else:
        met = points.select("point", F.col("fp").alias("a")).join(points.withColumnRenamed("fp", "b"), "point").select("a", "b")
    return met.filter((F.col("a") > F.col("b")) & (_distance("a", "b") <= max_bits))


def links(distinct: DataFrame, max_bits: int = 2, n_segments: int = 2, bucket_rows: int = 16) -> DataFrame:
    """Pairs (a, b) of the distinct fingerprints ``fp`` whose chains join all that lie within max_bits of each other."""
    cutouts = [(j, shift, width, r) for j, ((shift, width), r) in enumerate(zip(segments(n_segments), radii(max_bits, n_segments))) if r >= 0]

    def value(shift, width):
        return F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1).cast("long"))

    def ball(j, shift, width, radius):
        return F.transform(_masks(_ball(width, radius)), lambda m: F.struct(F.lit(j).alias("seg"), m.bitwiseXOR(value(shift, width)).alias("val")))

    filed = F.array(*[F.struct(F.lit(j).alias("seg"), value(s, w).alias("val")) for j, s, w, _ in cutouts])
    lookups = F.concat(*[ball(*c) for c in cutouts])
    index = distinct.select("fp", F.explode(filed).alias("k")).select("k.seg", "k.val", "fp")
    probes = distinct.select(F.col("fp").alias("a"), F.explode(lookups).alias("k")).select("k.seg", "k.val", "a")
    # a bucket's load and, while it is small, its fingerprints; a crowded bucket keeps none of them
    loads = index.groupBy("seg", "val").agg(F.count("*").alias("n"))
    crowded = loads.filter(F.col("n") > bucket_rows)
    matches = probes.join(index.join(loads.filter(F.col("n") <= bucket_rows).select("seg", "val"), ["seg", "val"]), ["seg", "val"])
    cold = matches.select("a", F.col("fp").alias("b")).filter((F.col("a") != F.col("b")) & (_distance("a", "b") <= max_bits))
    hot = (probes.join(crowded.select("seg", "val"), ["seg", "val"]).select(F.col("a").alias("fp")).distinct())
    return cold.union(_hot_links(cut(hot), max_bits, 4))


def fingerprint_components(rows: DataFrame, max_bits: int = 2) -> DataFrame:
    """(f, component, component_id) for each distinct fingerprint of the rows (id, fp): the component's smallest
    fingerprint and smallest id."""
    distinct = cut(rows.groupBy("fp").agg(F.min("id").alias("least")))
    reached = connected_components(links(distinct.select("fp"), max_bits))
    member = distinct.join(reached, distinct.fp == reached.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    least = member.groupBy("component").agg(F.min("least").alias("component_id"))
    return member.join(least, "component").select(F.col("fp").alias("f"), "component", "component_id")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                       max_bits: int = 2, seed: int = 42) -> DataFrame:
    """id_col, fingerprint (16 hex digits) and component_id of every row: the smallest id that links within
    ``max_bits`` differing bits reach, the row's own included.

    Shingles are ``words`` lower-cased words, joined by a space; a shorter text is one shingle, a text without words
    or a null text has fingerprint zero, linked like any other. Rows with equal fingerprints share a component.
    A null id is never a component_id as long as its component has another id; rows repeat as they do in the input;
    an empty table gives an empty result; other columns are not read.
    """
    rows = cut(fingerprints(docs, id_col, text_col, words, seed))
    known = fingerprint_components(rows, max_bits)
    return (rows.join(known, rows.fp == known.f, "left")
            .select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: that of the smallest id (a null id comes last);
    of several rows of that id the one with the smallest hash of its columns."""
    rows = cut(fingerprints(docs, id_col, text_col, words, keyed=True))
    known = fingerprint_components(rows, max_bits)
    alike = rows.join(known, rows.fp == known.f).groupBy("component", "id", "key").agg(F.count("*").alias("alike"))
    first = alike.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key", "alike")).alias("r"))
    return pick_rows(docs, first.select("r.id", "r.key", F.lit(1).cast("long").alias("copies"), "r.alike"), id_col)


def op5_simhash_components(spark, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"), words=3, max_bits=2)
