"""Language-model scores by prediction by partial matching (PPM) over bytes.

The model is a byte-context trie of depth ``order + 1``: for each context of up to ``order`` bytes the counts of the
bytes that followed it, and of the text's end. A symbol's probability starts at the longest context. A symbol not
seen there costs an escape, estimated from the number of distinct symbols (method C), and is looked for in the next
shorter context, whose counts leave out the symbols of the longer one (symbol exclusion). Below the empty context
all symbols not yet seen are alike.

The counts come from every training text. Leaves of the trie are numbers to the base 257: the symbol (256 is the end),
then the context's bytes from the last to the first. The trie is used in segments, each broadcast by itself: contexts
of three bytes and more by their last three bytes, so that all contexts which a symbol may fall back to down to three
bytes are in one segment; the shorter ones (at most 256**2 * 257 leaves) go with every segment. A segment has about
SEGMENT leaves; what shares three last bytes can't be parted, but is bounded by 256**(order - 3) * 257 leaves. Texts
are scored once for each segment, which adds the costs of the positions that belong to it.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import as_text, pick, stored, table
from tidecast.llm.simhash import _LOWER
from tidecast.session import shared_path

END = 256
SYMBOLS = 257
#: Contexts of up to LOW bytes go with every segment.
LOW = 2
#: About so many leaves in a segment of the trie.
SEGMENT = 2_000_000
#: A worker's word counts are handed on when they reach so many entries.
FLUSH = 300_000
#: Broadcast are the words that make up over 1 / HOT of the training tokens or of the held-out ones, fewer than 2 * HOT.
HOT = 1 << 19
#: So many symbols of a text at a time, which bounds the memory for very long texts.
STEP = 1 << 18
#: An Arrow batch is worked through in pieces of about so many bytes of text.
PIECE = 1 << 22


def is_held_out(doc_id, folds: int = 5, fold: int = 1) -> bool:
    """Whether crc32 of the id's decimal text falls into the held-out fold; a null id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == fold


def _pieces(batches):
    """The batches in slices of about PIECE bytes of text, or one longer text, so that what is made of them stays small."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        cuts = [0, *(np.flatnonzero(np.diff((size - 1) // PIECE)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)
        del batch


# -- counts ------------------------------------------------------------------------------------------------------


def _groups(texts: list[bytes], order: int):
    """The texts' symbols in arrays of about STEP: (symbols, place of each in its text, index of the text by which each
    run of symbols starts and where it starts, number of leading symbols that are context only)."""
    held, first, size = [], 0, 0
    for i, text in enumerate([*texts, None]):
        if held and (text is None or size + len(text) > STEP):
            lengths = np.array([len(t) + 1 for t in held])
            ends = np.cumsum(lengths)
            symbols = np.frombuffer(b"\0".join(held) + b"\0", np.uint8).astype(np.int64)
            symbols[ends - 1] = END
            starts = ends - lengths
            yield symbols, np.arange(len(symbols)) - np.repeat(starts, lengths), np.arange(first, first + len(held)), starts, 0
            held, size = [], 0
        if text is None:
            return
        if len(text) > STEP:  # in pieces, each with the context before it
            data = np.append(np.frombuffer(text, np.uint8).astype(np.int64), END)
            for a in range(0, len(data), STEP):
                lead = min(a, order)
                piece = data[a - lead:a + STEP]
                yield piece, np.arange(a - lead, a - lead + len(piece)), np.array([i]), np.array([0]), lead
            continue
        if not held:
            first = i
        held.append(text)
        size += len(text) + 1


def _codes(symbols: np.ndarray, order: int) -> np.ndarray:
    """Each symbol with the ``order`` symbols before it; the digits that lie before a text's start are to be cut off."""
    out, unit = symbols.copy(), 1
    for k in range(1, min(order, len(symbols) - 1) + 1):
        unit *= SYMBOLS
        out[k:] += symbols[:-k] * unit
    return out


def _leaves(texts: list[bytes], order: int):
    """(order, codes) of all leaves that the texts add to."""
    for symbols, place, _, _, lead in _groups(texts, order):
        codes = _codes(symbols, order)[lead:]
        place = place[lead:]
        yield order, codes[place >= order]
        for k in range(order):  # at a text's start contexts are shorter
            yield k, codes[place == k] % SYMBOLS ** (k + 1)


def _starts(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    first = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=first[1:])
    return np.flatnonzero(first)


def _add(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, starts, dtype=np.int64) if len(starts) else x


class _Sums:
    """Sums by code, kept as sorted pairs, to be handed on when they grow over ``most``. Codes are first collected, so that
    many are sorted at once; what they add is merged when it is as much as all before."""

    def __init__(self, most: int = 1_000_000):
        self.parts, self.held, self.most = [], 0, most
        self.raw, self.waiting, self.merged = [], 0, 0

    def add(self, codes: np.ndarray) -> None:
        self.raw.append(codes)
        self.waiting += len(codes)
        if self.waiting > self.most:
            self._sort()

    def _sort(self) -> None:
        codes = np.concatenate(self.raw)
        self.raw, self.waiting = [], 0
        codes.sort()
        new = _starts(codes)
        self.parts.append((codes[new], np.diff(new, append=len(codes))))
        self.held += len(new)
        if self.held > max(2 * self.merged, self.most):
            self.parts = [self.total()]
            self.merged = self.held = len(self.parts[0][0])

    def total(self):
        if self.raw:
            self._sort()
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(self.parts) == 1:
            return self.parts[0]
        codes, n = (np.concatenate(x) for x in zip(*self.parts))
        by = np.argsort(codes, kind="stable")  # runs in order, which are merged
        codes, n = codes[by], n[by]
        new = _starts(codes)
        return codes[new], _add(n, new)


def _count_batches(batches, order: int, folds: int, fold: int):
    """Partial counts of a partition's training texts: words as (-1, word, n), trie leaves as (order, code, n); and of
    the held-out texts' words, as (-2, word, n)."""
    sums = [_Sums() for _ in range(order + 1)]
    words, held, ends = Counter(), Counter(), 0
    names = ["ord", "code", "word", "n"]

    def word_rows(words, kind):
        keys = list(words)
        out = pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.nulls(len(keys), pa.int64()),
                                          pa.array(keys, pa.binary()), pa.array([words[k] for k in keys], pa.int64())], names)
        words.clear()
        return out

    def leaf_rows(k):
        codes, n = sums[k].total()
        sums[k] = _Sums()
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), k, np.int32)), pa.array(codes), pa.nulls(len(codes), pa.binary()), pa.array(n)], names)

    for batch in _pieces(batches):
        texts = []
        for i, value in zip(batch["id"].to_pylist(), batch["text"].cast(pa.binary())):
            kind, counts = (-2, held) if is_held_out(i, folds, fold) else (-1, words)
            text = value.as_py()
            if kind == -1:
                texts.append(text)
            counts.update(text.translate(_LOWER).split())
            if len(counts) > FLUSH:
                yield word_rows(counts, kind)
        ends += len(texts)
        for k, codes in _leaves(texts, order):
            sums[k].add(codes)
            if sums[k].merged > sums[k].most:
                yield leaf_rows(k)
    for kind, counts in ((-1, words), (-2, held)):
        if counts:
            yield word_rows(counts, kind)
    if ends:  # the end token: a word that no text can hold
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.nulls(1, pa.int64()), pa.array([b" "], pa.binary()), pa.array([ends], pa.int64())], names)
    for k in range(order + 1):
        if sums[k].parts or sums[k].raw:
            yield leaf_rows(k)


# -- the model ---------------------------------------------------------------------------------------------------


def _narrow(x: np.ndarray) -> np.ndarray:
    """Whole numbers as 32 bits, if they fit."""
    return x.astype(np.int32) if x.max(initial=0) < 1 << 31 else x


class _Level:
    """Contexts of one length: leaves, and of each context the sum and number of its symbols, and the sum that these
    symbols have in the context without its first byte."""

    def __init__(self, codes, counts, shorter: "_Level | None", k: int):
        by = np.argsort(codes, kind="stable")
        codes, counts = codes[by], counts[by]
        del by
        new = _starts(codes)
        self.codes = codes[new] if len(new) < len(codes) else codes
        self.counts = counts = _narrow(_add(counts, new))
        del codes, new
        contexts = self.codes // SYMBOLS
        new = _starts(contexts)
        self.contexts = contexts[new]
        del contexts
        self.size = np.diff(new, append=len(self.codes)).astype(np.int16)
        self.sums, self.kinds = _narrow(_add(counts, new)), self.size
        # whatever followed the longer context also followed the shorter one, so that all of these are found
        self.under = np.zeros(len(new), np.int32)
        if shorter:
            under = np.empty(len(self.codes), shorter.counts.dtype)
            for a in range(0, len(under), STEP):
                under[a:a + STEP] = shorter.counts[np.searchsorted(shorter.codes, self.codes[a:a + STEP] % SYMBOLS**k)]
            self.under = _narrow(_add(under, new))

    @staticmethod
    def find(table: np.ndarray, wanted: np.ndarray):
        """(places, found) of the wanted values in a sorted table."""
        if not len(table):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
        return at, table[at] == wanted


class Trie:
    """Costs in log10 of symbols in context, from sums (order, code, n) of leaves: those of contexts up to two bytes
    from all training texts (``low``), the others (``high``) from one segment."""

    def __init__(self, order: int, low, high):
        self.order, self.levels = order, []
        shorter = None
        for k in range(order + 1):
            part = low if k <= LOW else high
            codes, counts = [], []
            for longer in range(k, (min(order, LOW) if k <= LOW else order) + 1):  # leaves of longer contexts count here too
                here = part[0] == longer
                codes.append(part[1][here])
                counts.append(part[2][here])
                if longer > k:
                    codes[-1] %= SYMBOLS ** (k + 1)
            codes, counts = np.concatenate(codes), np.concatenate(counts)
            shorter = _Level(codes, counts, shorter, k)
            self.levels.append(shorter)
        del part, codes, counts, here
        # the longest contexts, where nearly all symbols are found: by a hash of the code, with its bucket's first entry
        top = self.levels[order]
        escapes = np.where(top.kinds < SYMBOLS, top.kinds, 0)
        cost = np.repeat(np.log10(top.sums + escapes), top.size)
        np.subtract(np.log10(top.counts), cost, out=cost)
        cost = cost.astype(np.float32)
        self.bits = max(4, len(cost).bit_length())
        bucket = self._bucket(top.codes).astype(np.int32)
        by = np.argsort(-top.counts, kind="stable").astype(np.int32)  # within a bucket frequent codes come first
        by = by[np.argsort(bucket[by], kind="stable")]
        self.first = np.zeros((1 << self.bits) + 1, np.int32)
        np.cumsum(np.bincount(bucket, minlength=1 << self.bits), out=self.first[1:])
        del bucket
        self.keys, self.cost = np.full(len(by) + 1, -1, np.int64), np.zeros(len(by) + 1, np.float32)
        np.take(top.codes, by, out=self.keys[:-1])
        np.take(cost, by, out=self.cost[:-1])
        top.codes, top.counts = np.zeros(0, np.int64), np.zeros(1, np.int32)  # found by hash, or not there
        for level in self.levels:
            level.size = None

    def _bucket(self, codes: np.ndarray) -> np.ndarray:
        return (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def costs(self, codes: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The cost of each symbol, whose context is as long as ``order`` and its place in the text allow."""
        bucket = self._bucket(codes)
        at = self.first.take(bucket)
        known = self.keys.take(at) == codes  # in an empty bucket's place stands another one's code
        long = place >= self.order
        known &= long
        out = self.cost.take(at).astype(np.float64)
        left = np.flatnonzero(known != long)
        at, end = at[left] + 1, self.first.take(bucket[left] + 1)
        while len(left):
            go = at < end
            left, at, end = left[go], at[go], end[go]
            hit = self.keys.take(at) == codes[left]
            out[left[hit]] = self.cost[at[hit]]
            known[left[hit]] = True
            left, at, end = left[~hit], at[~hit] + 1, end[~hit]
        rest = np.flatnonzero(~known)
        if len(rest):
            out[rest] = self._fall_back(codes[rest], place[rest])
        return out

    def _fall_back(self, codes, place):
        """Costs by escapes from the longest context down."""
        out = np.zeros(len(codes))
        open_ = np.ones(len(codes), bool)
        gone, kinds_gone = np.zeros(len(codes)), np.zeros(len(codes))  # of the symbols excluded so far
        for k in range(self.order, -1, -1):
            now = np.flatnonzero(open_ & (place >= k))
            level, own = self.levels[k], codes[now] % SYMBOLS ** (k + 1)
            c, seen = level.find(level.contexts, own // SYMBOLS)
            if not len(level.contexts):
                continue
            kinds = np.where(seen, level.kinds[c] - kinds_gone[now], 0)
            whole = np.where(seen, level.sums[c] - gone[now], 0)
            escapes = np.where(level.kinds[c] < SYMBOLS, kinds, 0)
            leaf, hit = level.find(level.codes, own)  # of the longest contexts none: the hash has been asked
            with np.errstate(divide="ignore", invalid="ignore"):
                cost = np.log10(np.where(hit, level.counts[leaf], escapes)) - np.log10(whole + escapes)
            said = hit | (kinds > 0)  # a context without symbols of its own is passed without an escape
            out[now[said]] += cost[said]
            open_[now[hit]] = False
            gone[now[seen]], kinds_gone[now[seen]] = level.under[c[seen]], level.kinds[c[seen]]
        out[open_] -= np.log10(SYMBOLS - kinds_gone[open_])
        return out

    def score(self, texts: list[bytes], segment: int = 0, segments: int = 1) -> np.ndarray:
        """For each text the cost of its positions that belong to the segment; the first segment also has those whose
        context is shorter than three bytes."""
        total = np.zeros(len(texts))
        for symbols, place, owner, starts, lead in _groups(texts, self.order):
            codes = _codes(symbols, self.order)
            if segments == 1:
                cost = self.costs(codes, place)
                cost[:lead] = 0
            else:
                cost = np.zeros(len(codes))
                mine = np.flatnonzero((segment_of(codes, place, segments) == segment) & (np.arange(len(codes)) >= lead))
                cost[mine] = self.costs(codes[mine], place[mine])
            total[owner] += np.add.reduceat(cost, starts)
        return total


def segment_of(codes: np.ndarray, place: np.ndarray, segments: int) -> np.ndarray:
    """The segment that holds each position's contexts of three bytes and more, by the last three."""
    last = codes // SYMBOLS % SYMBOLS**3
    return np.where(place > LOW, last % 65521 % segments, 0)


def adaptive_score(text: bytes, order: int = 5) -> float:
    """log10 probability of one text under a trie that starts empty and learns from the text as it goes."""
    trie: dict[bytes, Counter] = {}
    total, symbols = 0.0, [*text, END]
    for i, s in enumerate(symbols):
        excluded: set[int] = set()
        for k in range(min(order, i), -1, -1):
            counts = trie.setdefault(bytes(text[i - k:i]), Counter())
            rest = {x: n for x, n in counts.items() if x not in excluded}
            kinds = len(rest) if len(counts) < SYMBOLS else 0
            whole = sum(rest.values()) + kinds
            if s in rest:
                total += math.log10(rest[s] / whole)
                break
            if rest:
                total += math.log10(kinds / whole)
            excluded |= counts.keys()
        else:
            total -= math.log10(SYMBOLS - len(excluded))
        for k in range(min(order, i) + 1):
            trie[bytes(text[i - k:i])][s] += 1
    return total


# -- scoring -----------------------------------------------------------------------------------------------------

_TRIES: dict = {}
#: Cost of a word that no training text has; those of the others are above 0.
UNKNOWN = math.log10(0.5)


def _trie(key, sent) -> tuple[Trie, dict]:
    """The tables of this worker, made once for a broadcast segment."""
    if key not in _TRIES:
        _TRIES.clear()
        order, low, high, words = sent.value
        _TRIES[key] = Trie(order, low, high), words
    return _TRIES[key]


def _score_batches(batches, key, sent, segments: int, folds: int, fold: int):
    trie, hot = _trie(key, sent)
    get = hot.get
    for batch in _pieces(batches):
        texts = [v.as_py() for v in batch["text"].cast(pa.binary())]
        rows = []
        for i, text in zip(batch["id"].to_pylist(), texts):
            words = text.translate(_LOWER).split()
            words.append(b" ")
            costs = list(map(get, words))
            rare = [w for w, c in zip(words, costs) if c is None]
            if rare:
                costs = [c for c in costs if c is not None]
            rows.append((is_held_out(i, folds, fold), len(words), len(costs) - costs.count(UNKNOWN), math.fsum(costs), list(Counter(rare).items())))
        held, n, known, base, rare = zip(*rows) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays([batch["id"], batch["same"], pa.array(held, pa.bool_()), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                                          pa.array(base, pa.float64()), pa.array(trie.score(texts, 0, segments), pa.float64()),
                                          pa.array(rare, pa.map_(pa.binary(), pa.int64()))],
                                         ["id", "same", "held_out", "n_tokens", "n_hot", "hot_sum", "score", "rare"])


def _add_batches(batches, key, sent, segment: int, segments: int):
    trie, _ = _trie(key, sent)
    for batch in _pieces(batches):
        texts = [v.as_py() for v in batch["text"].cast(pa.binary())]
        yield pa.RecordBatch.from_arrays([batch["same"], pa.array(trie.score(texts, segment, segments), pa.float64())], ["same", "more"])


def _arrays(leaves: DataFrame) -> list[np.ndarray]:
    found = leaves.select("ord", "code", "n").toArrow()
    n = found["n"].to_numpy()
    return [found["ord"].to_numpy().astype(np.int8), found["code"].to_numpy(), n.astype(np.int32) if n.max(initial=0) < 1 << 31 else n]


def frequent_words(counted: DataFrame, n_train: int, n_held: int) -> dict[bytes, float]:
    """The words to broadcast, with their costs."""
    train = counted.filter("ord = -1").select("word", F.col("n").alias("c"))
    held = counted.filter("ord = -2").filter(F.col("n") * HOT > n_held).select("word").join(train, "word", "left")
    found = train.filter(F.col("c") * HOT > n_train).union(held.select("word", F.coalesce("c", F.lit(0)))).toArrow()
    return {w: math.log10(c + 0.5) if c else UNKNOWN for w, c in zip(found["word"].to_pylist(), found["c"].to_pylist())}


def ppm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 5, folds: int = 5,
               fold: int = 1, segment_leaves: int = SEGMENT) -> DataFrame:
    """PPM and unigram scores of every whole text, learnt from the texts outside the held-out fold.

    Result, one row per input row: id_col, held_out, n_tokens (words and one end), n_known (tokens seen in training),
    train_tokens, base_score (add-half unigram, log10), score (PPM: log10 of the probability of the text's bytes and
    its end).

    The counts of words and trie leaves are summed per partition, then over all. Broadcast, one after another, are the
    segments of the trie, and the words that make up over 1 / 2**19 of the training tokens or of the held-out ones
    (fewer than 2**20); all other words are joined to their counts by a shuffle, one row for each text and word, none of
    which can be frequent in either part.

    A null text counts as empty (one end token); a null id counts as the empty text for the fold; repeated rows are
    learnt from and scored as often as they stand there; other columns are not read. Without training texts every
    token costs log10(1) and all symbols are alike; an empty table gives an empty result.
    """
    if not 0 <= order <= 6:
        raise ValueError("order must be from 0 to 6")  # seven digits to the base 257 fit a long
    spark = docs.sparkSession
    kind = dict(docs.select(id_col).dtypes)[id_col]
    rows = pick(docs, id=id_col, text=text_col).withColumn("text", as_text(F.col("text")))
    rows = rows.withColumn("same", F.hash("text").cast("long") * (1 << 32) + F.crc32(F.encode("text", "UTF-8")))
    counted = stored(rows.mapInArrow(lambda it: _count_batches(it, order, folds, fold), "ord int, code long, word binary, n long")
                     .repartition("ord", "code", "word")  # a partition's rows hardly repeat: summed after the exchange only
                     .groupBy("ord", "code", "word").agg(F.sum("n").alias("n")), "lm-counts")
    words = counted.filter("ord = -1").select("word", F.col("n").alias("c"))
    n_train, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n_held = counted.filter("ord = -2").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = frequent_words(counted, n_train, n_held)
    leaves = counted.filter("ord >= 0").select("ord", "code", "n")
    short = F.least("ord", F.lit(LOW))
    low = _arrays(leaves.groupBy(short.alias("ord"), F.expr(f"code % CASE ord WHEN 0 THEN {SYMBOLS} WHEN 1 THEN {SYMBOLS**2} ELSE {SYMBOLS**3} END").alias("code"))
                    .agg(F.sum("n").alias("n")))
    high = leaves.filter(F.col("ord") > LOW)
    segments = max(1, -(-high.count() // segment_leaves))
    number = F.expr(f"(code div {SYMBOLS}) % {SYMBOLS**3} % 65521 % {segments}")
    path = shared_path(spark, "lm-scores")

    def send(segment, words):
        sent = spark.sparkContext.broadcast((order, low, _arrays(high.filter(number == segment)), words))
        return sent, sent._jbroadcast.id()

    sent, key = send(0, hot)
    scored = stored(rows.mapInArrow(lambda it: _score_batches(it, key, sent, segments, folds, fold),
                                    f"id {kind}, same long, held_out boolean, n_tokens long, n_hot long, hot_sum double, score double, rare map<binary, long>")
                    .withColumn("row", F.monotonically_increasing_id()), "lm-scores")
    for segment in range(1, segments):  # one broadcast at a time; equal texts have equal sums
        sent, key = send(segment, {})
        (rows.select("same", "text").mapInArrow(lambda it: _add_batches(it, key, sent, segment, segments), "same long, more double")
         .groupBy("same").agg(F.max("more").alias("more")).write.mode("append").parquet(path))
        sent.destroy()
    if segments > 1:
        more = spark.read.parquet(path).groupBy("same").agg(F.sum("more").alias("more"))
        scored = stored(scored.join(more, "same", "left").withColumn("score", F.col("score") + F.coalesce("more", F.lit(0.0))).drop("more"), "lm-scores")
    rare = (scored.select("row", F.explode("rare").alias("word", "k")).join(words.filter(F.col("c") * HOT <= n_train), "word", "left")
            .groupBy("row").agg(F.sum(F.when(F.col("c").isNotNull(), F.col("k"))).alias("n_rare"),
                                F.sum(F.col("k") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare_sum")))
    whole = math.log10(n_train + 0.5 * (distinct + 1))
    return (scored.drop("rare").join(rare, "row", "left")
            .select(F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_hot") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
                    F.lit(n_train).cast("long").alias("train_tokens"),
                    (F.col("hot_sum") + F.coalesce("rare_sum", F.lit(0.0)) - F.col("n_tokens") * F.lit(whole)).alias("base_score"), "score"))


def op3_ppm_scores(spark, sf_dir: str) -> DataFrame:
    return ppm_scores(table(spark, sf_dir, "documents"), order=5, folds=5, fold=1)
