"""Cross-tokenizer alignment: where the tokens of two tokenizers end together, and which of them overlap.

Both tokenizers' token ends are offsets on one axis of bytes. The shorter list of ends drives an exponential and then
binary search into the longer one (galloping): what is found exactly is a common end, and common ends slice the tokens into groups;
the rank of a driver's end less that of its start is the range of tokens it overlaps. Searches run over arrays, for a
few documents at a time; the documents' own ends are common ones, so that these are one long text.

Counts of linked id pairs are needed from the whole corpus. A block of many such pieces counts its own pairs first and is stored as one row: pairs,
counts, and its links as numbers of pairs. The blocks' pairs are summed by Spark, and each block is cogrouped with the sums of its own pairs.
"""

from __future__ import annotations

import json
import os
import re
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm.bpe import PATTERN, byte_letters, public_vocabulary
from tidecast.llm.common import pick, stored, table

#: A block is closed when it has so many characters or documents; a longer document makes a longer block.
BLOCK_CHARS, BLOCK_DOCS = 1 << 22, 20_000
#: Tokens and links are made for so many characters of a block at a time, or one longer document.
PIECE_CHARS = 1 << 18
#: Every so many ends of the driving list are searched first; the others then lie between two known places.
ANCHOR = 16


class ByteLevel:
    """A byte-level BPE file: ids of a text, and the bytes of each id. Special strings count as plain text.

    Texts of Latin letters go through the faster of two libraries, which merges by the ids' order; that gives the same ids
    where ids follow the order of merges, which is checked. All other texts go through the file's own library, as
    the libraries may know different versions of Unicode."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        special = {t["content"] for t in spec.get("added_tokens", [])}
        tokens = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        size = max(vocab.values()) + 1
        self.bytes = [b""] * size
        for t, i in tokens.items():
            self.bytes[i] = t
        self.slow = Tokenizer.from_file(path)
        self.slow.no_truncation()
        self.slow.no_padding()
        self.slow.encode_special_tokens = True
        self.fast = None
        if merged == sorted(set(merged)) and len(tokens) == len(merged) + 256 and max(tokens.values()) + 1 == len(tokens):
            import tiktoken
            self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=tokens, special_tokens={})
        self.foreign = re.compile("[^\0-ͯ]").search

    def encode(self, text: str) -> list[int]:
        if self.fast is None or not text.isascii() and self.foreign(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class Pieces:
    """A sentencepiece file: ids of texts, and the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        piece = self.model.id_to_piece
        self.bytes = [bytes([int(piece(i)[3:5], 16)]) if self.model.is_byte(i) else piece(i).replace("▁", " ").encode()
                      for i in range(self.model.get_piece_size())]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []


def _search(ends, at, first, last, into):
    """For each of ``ends`` the first place in ``into[first:last + 1]`` with a value not below it, found by steps that
    double from ``at`` on, up or down, and halving between the last two."""
    below = into[at] < ends
    low, high = np.where(below, at + 1, first), np.where(below, last, at)
    lanes, step = np.arange(len(ends)), 1
    while len(lanes):
        up, base = below[lanes], at[lanes]
        probe = np.clip(np.where(up, base + step, base - step), low[lanes], high[lanes])
        reached = into[probe] >= ends[lanes]
        high[lanes] = np.where(reached, probe, high[lanes])
        low[lanes] = np.where(reached, low[lanes], probe + 1)
        # upwards the search ends at the first value not below, downwards at the first below
        lanes = lanes[(reached != up) & (low[lanes] < high[lanes])]
        step *= 2
    lanes = np.flatnonzero(low < high)
    while len(lanes):
        middle = low[lanes] + high[lanes] >> 1
        reached = into[middle] >= ends[lanes]
        high[lanes] = np.where(reached, middle, high[lanes])
        low[lanes] = np.where(reached, low[lanes], middle + 1)
        lanes = lanes[low[lanes] < high[lanes]]
    return low


def gallop(short: np.ndarray, n_short: np.ndarray, long: np.ndarray, first: np.ndarray, n_long: np.ndarray) -> np.ndarray:
    """For each end in ``short`` the first place in ``long`` with an end not below it. Lists of several documents stand
    one after another: document d has the next ``n_short[d]`` of ``short`` and ``long[first[d]:first[d] + n_long[d]]``,
    both with the same last end."""
    if not len(short):
        return np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(n_short)), n_short)
    rank = np.arange(len(short)) - np.repeat(np.cumsum(n_short) - n_short, n_short)
    begin, end = first[doc], first[doc] + n_long[doc] - 1
    guess = begin + rank * n_long[doc] // n_short[doc]
    found = np.empty(len(short), np.int64)
    # the anchors: every 16th of a document, and its last
    anchor = (rank % ANCHOR == 0) | (rank == n_short[doc] - 1)
    at = np.flatnonzero(anchor)
    found[at] = _search(short[at], guess[at], begin[at], end[at], long)
    # the others lie between the anchors before and after
    rest = np.flatnonzero(~anchor)
    k = np.cumsum(anchor)[rest] - 1
    before, after = at[k], at[np.minimum(k + 1, len(at) - 1)]
    low, high = found[before], found[after]
    found[rest] = _search(short[rest], low + (rest - before) * (high - low) // np.maximum(after - before, 1), low, high, long)
    return found


def links(short, n_short, long, first, n_long):
    """(common ends as places in both lists, links as places in both lists) of documents as in ``gallop``."""
    at = gallop(short, n_short, long, first, n_long)
    exact = long[at] == short
    starts = np.cumsum(n_short) - n_short
    low = np.empty(len(at), np.int64)
    low[1:] = at[:-1] + exact[:-1]
    low[starts[n_short > 0]] = first[n_short > 0]
    many = at - low + 1
    own = np.repeat(np.arange(len(at)), many)
    other = np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
    common = np.flatnonzero(exact)
    return (common, at[common]), (own, other)


class Aligner:
    """Both tokenizers, and the written forms of their ids."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.a_len, self.b_len = (np.array([len(t) for t in x.bytes], np.int64) for x in (self.a, self.b))
        # 2 * id: the id and a comma; 2 * id + 1: the id as the last of its side; B's stand after A's
        self.written = [b"%d%c" % (i, c) for ends, t in ((b",|", self.a), (b",;", self.b)) for i in range(len(t.bytes)) for c in ends]

    def tokens(self, texts: list):
        """Ids by both of each text; none where either doesn't give back the text's bytes."""
        b_ids = iter(self.b.encode([t for t in texts if t]))
        out = []
        for text in texts:
            if not text:
                out.append(([], []))
                continue
            b, raw = next(b_ids), f" {text}".encode()
            if b"".join(map(self.b.bytes.__getitem__, b)) != raw:
                out.append(([], []))
                continue
            a = self.a.encode(f" {text}")
            out.append((a, b) if b"".join(map(self.a.bytes.__getitem__, a)) == raw else ([], []))
        return out

    def piece(self, ids: list, texts: list, with_groups: bool) -> dict:
        """Some documents' columns; ``keys``, the id pairs that their links hold, and ``codes``, each link's place among these."""
        both = self.tokens(texts)
        # documents whose A list drives come first: a piece's links then stand in order of documents
        order = sorted(range(len(ids)), key=lambda i: len(both[i][0]) > len(both[i][1]))
        both = [both[i] for i in order]
        n_a, n_b = (np.array([len(x[side]) for x in both], np.int64) for side in (0, 1))
        a, b = (np.array([i for x in both for i in x[side]], np.int64) for side in (0, 1))
        a_end, b_end = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        a_at, b_at = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        cut = int((n_a <= n_b).sum())
        head, tail = slice(0, cut), slice(cut, None)
        a_cut, b_cut = int(n_a[head].sum()), int(n_b[head].sum())
        (a1, b1), (la1, lb1) = links(a_end[:a_cut], n_a[head], b_end, b_at[head], n_b[head])
        (b2, a2), (lb2, la2) = links(b_end[b_cut:], n_b[tail], a_end, a_at[tail], n_a[tail])
        # one past the last token of each group, in both lists
        a_stop, b_stop = np.concatenate([a1, a2]) + 1, np.concatenate([b1, b2 + b_cut]) + 1
        link_a, link_b = np.concatenate([la1, la2]), np.concatenate([lb1, lb2 + b_cut])
        # B's places rise with A's, so that both sides count the links of a document alike
        bounds = np.searchsorted(link_a, np.concatenate([a_at, [len(a)]]))
        n_groups = np.searchsorted(a_stop, a_at + n_a, "right") - np.searchsorted(a_stop, a_at, "right")
        digests, groups = self._written(a, b, a_stop, b_stop, a_at + b_at, n_a + n_b, with_groups)
        codes, keys = pd.factorize(a[link_a] << 32 | b[link_b])
        return {"doc": [ids[i] for i in order], "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": np.diff(bounds), "sha": digests,
                "groups": groups, "keys": keys, "codes": codes.astype(np.uint32)}

    @staticmethod
    def block(pieces: list[dict]) -> dict:
        """The pieces' columns one after another, with numbers of pairs that hold for all, and the pairs' counts."""
        out = {c: sum((x[c] for x in pieces), []) if isinstance(pieces[0][c], list) else np.concatenate([x[c] for x in pieces])
               for c in pieces[0] if c not in ("keys", "codes")}
        own, keys = pd.factorize(np.concatenate([x["keys"] for x in pieces]))
        counts = np.zeros(len(keys), np.int64)
        maps = np.split(own, np.cumsum([len(x["keys"]) for x in pieces])[:-1])
        for x, into in zip(pieces, maps):  # a piece's pairs are distinct
            counts[into] += np.bincount(x["codes"], minlength=len(into))
        by = np.argsort(-counts, kind="stable")  # frequent pairs get small numbers, which pack well
        number = np.empty(len(keys), np.uint32)
        number[by] = np.arange(len(keys))
        pack = zstandard.ZstdCompressor(level=1).compressobj(size=4 * sum(len(x["codes"]) for x in pieces))
        packed = [pack.compress(number[into[x["codes"]]].tobytes()) for x, into in zip(pieces, maps)]
        return {**out, "keys": keys[by], "counts": counts[by], "codes": b"".join(packed) + pack.flush()}

    def _written(self, a, b, a_stop, b_stop, at, n, with_groups: bool):
        """For each document the digest of its groups as text, and the text if wanted."""
        a_size, b_size = np.diff(a_stop, prepend=0), np.diff(b_stop, prepend=0)
        a_last, b_last = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        a_last[a_stop - 1] = 1
        b_last[b_stop - 1] = 1
        seq = np.empty(len(a) + len(b), np.int64)
        seq[np.arange(len(a)) + np.repeat(b_stop - b_size, a_size)] = 2 * a + a_last
        seq[np.arange(len(b)) + np.repeat(a_stop, b_size)] = 2 * (b + len(self.a_len)) + b_last
        digests, groups = [], []
        form = self.written.__getitem__
        for start, many in zip(at.tolist(), n.tolist()):
            text = b"".join(map(form, seq[start:start + many].tolist()))[:-1]
            digests.append(sha256(text).hexdigest() if many else "")
            groups.append(text.decode() if with_groups else None)
        return digests, groups


_BLOCK = ("block long, doc array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, sha array<string>, "
          "groups array<string>, keys array<long>, counts array<long>, codes binary")
_MADE: dict = {}


def _aligner(*paths) -> Aligner:
    if paths not in _MADE:
        _MADE.clear()
        _MADE[paths] = Aligner(*paths)
    return _MADE[paths]


def _block_batches(batches, a_path: str, b_path: str, with_groups: bool, chars: int):
    aligner, seq = _aligner(a_path, b_path), TaskContext.get().partitionId() << 32
    pieces, ids, texts, held, docs, size = [], [], [], 0, 0, 0
    kinds = {"doc": pa.int64(), "sha": pa.string(), "groups": pa.string()}

    def row():
        made = aligner.block(pieces)
        arrays = [pa.array([seq])]
        for name, value in made.items():
            if name == "codes":
                arrays.append(pa.array([value], pa.binary()))
            else:
                items = pa.array(value, kinds.get(name, pa.int64()))
                arrays.append(pa.ListArray.from_arrays(pa.array([0, len(items)], pa.int32()), items))
        return pa.RecordBatch.from_arrays(arrays, ["block", *made])

    for batch in batches:
        for i, text in zip(batch["id"].to_pylist(), batch["text"]):
            ids.append(i)
            texts.append(text.as_py())
            docs, held, size = docs + 1, held + len(texts[-1] or ""), size + len(texts[-1] or "")
            full = held >= chars or docs >= BLOCK_DOCS
            if full or size >= PIECE_CHARS:
                pieces.append(aligner.piece(ids, texts, with_groups))
                ids, texts, size = [], [], 0
            if full:
                yield row()
                pieces, held, docs, seq = [], 0, 0, seq + 1
    if ids:
        pieces.append(aligner.piece(ids, texts, with_groups))
    if pieces:
        yield row()


def align_blocks(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                 with_groups: bool = False, chars: int = BLOCK_CHARS) -> DataFrame:
    """Blocks of aligned documents, stored: one row a block, as large as a few million characters or one document."""
    rows = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(lambda it: _block_batches(it, a_path, b_path, with_groups, chars), _BLOCK), "align-blocks")


def _pairs(blocks: DataFrame) -> DataFrame:
    return blocks.select("block", F.posexplode(F.arrays_zip("keys", "counts")).alias("pos", "pair")).select(
        "block", "pos", F.col("pair.keys").alias("key"), F.col("pair.counts").alias("n"))


def pair_counts(blocks: DataFrame) -> DataFrame:
    """key, a_id, b_id and count (links corpus-wide) of every id pair that a link holds."""
    out = _pairs(blocks).groupBy("key").agg(F.sum("n").alias("count"))
    return out.select("key", F.shiftright("key", 32).alias("a_id"), F.expr("key & 4294967295").alias("b_id"), "count")


_RESULT = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _finish(block: pa.Table, known: pa.Table, with_groups: bool) -> pa.Table:
    get = lambda c: block[c].chunk(0).values
    keys = len(get("keys"))
    count, best = np.zeros(keys, np.int64), np.zeros(keys, np.int64)
    pos = known["pos"].to_numpy()
    count[pos], best[pos] = known["count"].to_numpy(), known["best"].to_numpy()
    codes = np.frombuffer(zstandard.ZstdDecompressor().decompress(block["codes"][0].as_py()), np.uint32)
    n_links = get("n_links").to_numpy()
    some = np.flatnonzero(n_links)
    sums = np.zeros((2, len(n_links)), np.int64)
    if len(some):
        for x, into in zip((best, count), sums):
            into[some] = np.add.reduceat(x[codes], (np.cumsum(n_links) - n_links)[some])
    out = {"id": get("doc"), **{c: get(c) for c in ("n_a", "n_b", "n_groups", "n_links")},
           "n_best": sums[0], "count_sum": sums[1], "groups_sha256": get("sha")}
    if with_groups:
        out["groups"] = get("groups")
    return pa.table(out)


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False,
          chars: int = BLOCK_CHARS) -> DataFrame:
    """Every whole text by two tokenizers: A, a byte-level BPE file that gets a space before the text, and B, a
    sentencepiece file that adds this space itself.

    Result, one row per input row: id_col; n_a, n_b (tokens); n_groups (slices between common ends); n_links (overlapping
    pairs of tokens); n_best (links whose id pair has the highest count of its B id, ties included); count_sum (of
    the pairs' counts over the links); groups_sha256 and, ``with_groups``, the groups as text: ``a1,a2|b1;a3|b2,b3``.
    A pair's count is the number of links in all texts that hold it.

    Null and empty texts, and texts whose bytes a tokenizer doesn't give back, have no tokens: zeros and an empty digest.
    Null ids stay null; rows repeat as they do in the input (and count as often); other columns are not read; an
    empty table gives no rows. Very long texts are one block each, in memory in proportion to themselves.
    Broadcast is one row per id of B, at most its vocabulary.
    """
    blocks = align_blocks(docs, a_path, b_path, id_col, text_col, with_groups, chars)
    counts = stored(pair_counts(blocks), "align-pairs")
    most = counts.groupBy("b_id").agg(F.max("count").alias("most"))
    scored = counts.join(F.broadcast(most), "b_id").select("key", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))
    known = _pairs(blocks).select("block", "pos", "key").join(scored, "key").select(F.col("block").alias("of"), "pos", "count", "best")
    schema = _RESULT + (", groups string" if with_groups else "")
    out = blocks.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(lambda x, y: _finish(x, y, with_groups), schema)
    return out.withColumnRenamed("id", id_col)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), public_vocabulary(), public_vocabulary("piece_bpe_32k.model"))
