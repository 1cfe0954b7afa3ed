"""BPE encoding by backtracking over longest token matches, decoding through an offset table.

The encoder walks a pre-token from left to right and always tries the longest token that starts at the position
(found by an Aho-Corasick automaton), then its shorter prefixes. A token may follow another only if merging their
joint bytes gives exactly these two; the answer is kept in a pair-compatibility table. When nothing fits, the last
token goes back and the position is marked as a dead end, so that each position is left at most once: the result is
the exact merge sequence, in linear time.
"""

from __future__ import annotations

import json

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import as_text, pick, sha256, table

# The pre-token pattern of byte-level BPE vocabularies and the printable stand-ins of its bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tables of a byte-level BPE file: token bytes, ids, merges, specials. Its size is that of the file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, kind = spec["model"], spec["pre_tokenizer"] or {}
        plain = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        if model["type"] != "BPE" or any(model.get(x) for x in plain) or spec.get("normalizer") or \
                kind.get("type") != "ByteLevel" or kind.get("add_prefix_space") or not kind.get("use_regex", True):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        letters, vocab = byte_letters(), model["vocab"]
        to_bytes = lambda token: bytes(letters[c] for c in token)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # tokens are numbered by rank: the single bytes first, then the merges in their order
        self.token = [bytes([b]) for b in range(256)]
        rank = {t: i for i, t in enumerate(self.token)}
        self.split, self.pair = [(i, i) for i in range(256)], {}
        for left, right in merges:
            a, b = rank[to_bytes(left)], rank[to_bytes(right)]
            joined = self.token[a] + self.token[b]
            if joined not in rank:
                rank[joined] = len(self.token)
                self.token.append(joined)
                self.split.append((a, b))
            self.pair.setdefault((a, b), rank[joined])
        ids = {to_bytes(t): i for t, i in vocab.items() if all(c in letters for c in t)}
        self.id = [ids.get(t, -1) for t in self.token]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", [])):
            raise ValueError("added tokens that take in neighbouring text are not supported")
        self.decoded = {i: t for t, i in ids.items()} | {i: s.encode() for s, i in self.special.items()}


class Encoder:
    """Encodes and decodes with a Vocabulary. What it keeps is bounded: ``most`` words, as many pair answers."""

    def __init__(self, vocabulary: Vocabulary, most: int = 400_000):
        v = self.v = vocabulary
        self.most, self.valid, self.words = most, {}, {}
        self.find = regex.compile(PATTERN).findall
        self.rank = {t: i for i, t in enumerate(v.token)}
        # the automaton holds reversed tokens and reads a word from its end: the longest match that ends at a place
        # of the reversed word is the longest token that starts there
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        known = set(range(256))
        for t in range(256, len(v.token)):
            if v.id[t] >= 0 and known.issuperset(v.split[t]) and self._fits(*v.split[t], t):  # merging its bytes gives it
                known.add(t)
        for t in known:
            self.automaton.add_word(v.token[t][::-1].decode("latin-1"), t)
        self.automaton.make_automaton()
        self.shorter = [next((self.rank[w[:n]] for n in range(len(w) - 1, 0, -1) if self.rank.get(w[:n]) in known), -1)
                        for w in v.token]
        self.length = [len(t) for t in v.token]
        self.id_bytes = [max(i, 0).to_bytes(4, "little") for i in v.id]
        # the offset table: token i is blob[offset[i]:offset[i + 1]]
        top = max(v.decoded, default=-1) + 1
        self.offset = np.zeros(top + 1, np.int64)
        self.offset[1:] = np.cumsum([len(v.decoded.get(i, b"")) for i in range(top)])
        self.blob = np.frombuffer(b"".join(v.decoded.get(i, b"") for i in range(top)), np.uint8)
        self.specials = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(v.special, key=len, reverse=True)) + ")") if v.special else None

    def _fits(self, a: int, b: int, limit: int) -> bool:
        """Whether no merge of a rank under ``limit`` crosses the border between tokens a and b while both form."""
        pair, split = self.v.pair, self.v.split
        while True:
            if pair.get((a, b), limit) < limit:
                return False
            # undo whichever of the two was merged last; the later one being a single byte, both are
            if max(a, b) < 256:
                return True
            if a > b:
                limit, a = a, split[a][1]
            else:
                limit, b = b + 1, split[b][0]

    def compatible(self, a: int, b: int) -> bool:
        key = a << 32 | b
        known = self.valid.get(key)
        if known is None:
            if len(self.valid) >= self.most:
                self.valid.clear()
            known = self.valid[key] = self._fits(a, b, 1 << 62)
        return known

    def ranks(self, word: bytes) -> list[int]:
        """The tokens of one pre-token, by rank."""
        n = len(word)
        longest = [-1] * (n + 1)
        for end, t in self.automaton.iter(word[::-1].decode("latin-1")):
            at = n - 1 - end
            if longest[at] < 0 or self.length[t] > self.length[longest[at]]:
                longest[at] = t
        out, at, dead, token = [], 0, bytearray(n + 1), longest[0]
        length, shorter, compatible = self.length, self.shorter, self.compatible
        while at < n:
            last = out[-1] if out else -1
            while token >= 0 and (dead[at + length[token]] or last >= 0 and not compatible(last, token)):
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += length[token]
                token = longest[at]
            else:  # a dead end: the last token is tried shorter
                dead[at] = 1
                token = out.pop()
                at -= length[token]
        return out

    def _word(self, word: str) -> bytes:
        code = b"".join([self.id_bytes[t] for t in self.ranks(word.encode())])
        if len(self.words) >= self.most:
            self.words.clear()
        if len(word) <= 64:
            self.words[word] = code
        return code

    def _plain(self, text: str) -> bytes:
        get, make = self.words.get, self._word
        return b"".join([get(w) or make(w) for w in self.find(text)])

    def encode(self, text: str) -> bytes:
        """The ids of the text as little-endian unsigned 32-bit integers. Special strings give their own id."""
        if self.specials is None or not self.specials.search(text):
            return self._plain(text)
        parts = self.specials.split(text)
        return b"".join(self.v.special[p].to_bytes(4, "little") if i % 2 else self._plain(p) for i, p in enumerate(parts))

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids (those of any byte sequence; the text is their UTF-8 with replacement)."""
        if not len(ids):
            return b""
        start = self.offset[ids]
        size = self.offset[ids.astype(np.int64) + 1] - start
        ends = np.cumsum(size)
        at = np.arange(ends[-1], dtype=np.int64)
        at += np.repeat(start - (ends - size), size)
        return self.blob[at].tobytes()


_ENCODERS: dict[int, Encoder] = {}


def _encoder(sent) -> Encoder:
    """The encoder of this worker, made once for a broadcast vocabulary."""
    if sent.id not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[sent.id] = Encoder(sent.value)
    return _ENCODERS[sent.id]


class _Sent:
    """A broadcast vocabulary (as large as its file, under 2 MB as text) with a stable key."""

    def __init__(self, spark, vocabulary: Vocabulary):
        self.broadcast = spark.sparkContext.broadcast(vocabulary)
        self.id = self.broadcast._jbroadcast.id()

    @property
    def value(self):
        return self.broadcast.value


#: Decoding works on so many ids at a time, which bounds its memory for very long texts.
DECODE_IDS = 1 << 20


def _encode_batches(batches, sent, with_ids: bool):
    coder = _encoder(sent)
    for batch in batches:
        n, ids_hash, text_hash, ids_out, text_out = [], [], [], [], []
        for text in batch["text"]:
            code = coder.encode(text.as_py())
            ids = np.frombuffer(code, "<u4")
            raw = b"".join(coder.decode(ids[a:a + DECODE_IDS]) for a in range(0, len(ids), DECODE_IDS))
            back = raw.decode("utf-8", "replace")
            n.append(len(ids))
            ids_hash.append(sha256(code))
            text_hash.append(sha256(back.encode()))
            if with_ids:
                ids_out.append(ids.astype(np.int32))
                text_out.append(back)
        arrays = [batch["id"], pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
        names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            arrays += [pa.array(ids_out, pa.list_(pa.int32())), pa.array(text_out, pa.string())]
            names += ["ids", "decoded"]
        yield pa.RecordBatch.from_arrays(arrays, names)


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = True) -> DataFrame:
    """Every whole text encoded with the vocabulary file ``vocabulary`` and decoded again.

    Result, one row per input row: id_col, n_tokens, ids_sha256 (of little-endian unsigned 32-bit ids),
    decoded_sha256 and, ``with_ids``, the ids and the decoded text.

    A null text counts as empty: no tokens, the hash of nothing. Null ids stay null, repeated rows stay repeated;
    other columns are not read; an empty table gives an empty result. Texts are not cut: a very long one takes
    memory in proportion to itself, decoding works through it in steps. Special strings within a text give their
    special id. The vocabulary's tables are broadcast; their size is that of the file.
    """
    rows = pick(docs, id=id_col, text=text_col).withColumn("text", as_text(F.col("text")))
    sent = _Sent(docs.sparkSession, Vocabulary(vocabulary))
    kind = dict(rows.dtypes)["id"]
    more = ", ids array<int>, decoded string" if with_ids else ""
    out = rows.mapInArrow(lambda it: _encode_batches(it, sent, with_ids),
                          f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
    return out.withColumnRenamed("id", id_col)


def public_vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of the documents with the public byte-level vocabulary."""
    return encode_decode(docs, public_vocabulary(), with_ids=False)


def op2_bpe_roundtrip(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
