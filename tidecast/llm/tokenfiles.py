"""Token-id files: documents are tokenized, written in the format of ``codec`` in order of id, and read back."""

from __future__ import annotations

import os
import re
import string
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm.codec import read_file, write_file
from tidecast.llm.common import as_text, pick, table
from tidecast.llm.bpe import byte_letters, public_vocabulary
from tidecast.session import shared_path

#: A file is closed when it has so many ids; a longer document makes a longer file.
FILE_IDS = 1 << 23


#: Packers of so many ids.
_FORMS = [struct.Struct(f"<{n}I").pack for n in range(64)]


def _latin1(text: str) -> bool:
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


class ChunkIds(dict):
    """Ids of chunks of text without white space, as bytes; keeps the last ``most`` to twice as many chunks.

    Only for byte-level tokenizers that lower-case, drop white space and never look across it, so that a text's ids are
    those of its chunks one after another."""

    def __init__(self, path: str, most: int = 500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer, self.most, self.older = Tokenizer.from_file(path), most, {}
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # what the tokenizer's normalizer and pre-tokenizer make of a lower-case Latin word, given to its model at once
        self.tokenize = self.tokenizer.model.tokenize  # each access to the model makes a new object
        self.letters = {b: c for c, b in byte_letters().items()}
        self.plain = re.compile("[a-zß-öø-ɏ]+").fullmatch

    def __missing__(self, chunk: str) -> bytes:
        code = self.older.get(chunk)
        if code is None:
            if chunk.isascii() and chunk.isalpha():
                body, word = chunk, chunk.lower()
                plain = True
            else:
                body = chunk.rstrip(string.punctuation)
                word = body.lower()
                plain = self.plain(word)
            if not plain:
                code = self._pack(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
            elif word != chunk:  # letters and other signs never share a word of the tokenizer's
                code = self[word] + self[chunk[len(body):]] if body != chunk else self[word]
            else:
                code = self._pack([t.id for t in self.tokenize(
                    chunk if chunk.isascii() else chunk.encode().decode("latin-1").translate(self.letters))])
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        if len(chunk) <= 64:
            self[chunk] = code
        return code

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return _FORMS[len(ids)](*ids) if len(ids) < len(_FORMS) else struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, text: str) -> bytes:
        # four control characters are white space to split(), but not to the tokenizer
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if _latin1(text):  # composed already, and every lower-case letter is one of these too: capitals are no chunks of their own
            text = text.lower()
        return b"".join(map(self.__getitem__, text.split()))


_CHUNKS: dict[str, ChunkIds] = {}


def _chunks(path: str) -> ChunkIds:
    if path not in _CHUNKS:
        _CHUNKS.clear()
        _CHUNKS[path] = ChunkIds(path)
    return _CHUNKS[path]


FILE_SCHEMA = "part int, seq int, first long, docs long, ids long, data binary"


def _write_batches(batches, path: str, end_id: int):
    """A partition's files, its rows coming in order of id."""
    chunks, part, seq, first = _chunks(path), TaskContext.get().partitionId(), 0, 0
    docs: list = []
    codes: list[bytes] = []
    held = 0
    end = end_id.to_bytes(4, "little")

    def file():
        nonlocal seq, first, held, docs, codes
        lengths = np.array([len(c) // 4 for c in codes], np.int64)
        ids = np.frombuffer(b"".join(codes), "<u4").astype(np.int32)
        row = [part, seq, first, len(docs), len(ids), write_file(docs, lengths, ids)]
        seq, first, held, docs, codes = seq + 1, first + len(ids), 0, [], []
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, [pa.int32()] * 2 + [pa.int64()] * 3 + [pa.binary()])],
                                          ["part", "seq", "first", "docs", "ids", "data"])

    for batch in batches:
        for i, text in zip(batch["id"].to_pylist(), batch["text"]):
            docs.append(i)
            codes.append(chunks.ids(text.as_py()) + end)
            held += len(codes[-1]) // 4
            if held >= FILE_IDS:
                yield file()
    if docs:
        yield file()


def write_token_files(docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2) -> None:
    """Write the ids of all texts, each followed by ``end_id``, as a table of token files at ``path``.

    Rows are dealt out by ranges of id and sorted within (null ids first; rows of one id by their texts' checksums, which
    keep them apart where ranges are cut), so that files in order of (part, seq) hold the documents in ascending order. ``first`` is the number of ids before
    the file in its part. A null text counts as empty: it has just its end id. Rows repeat as they do in the input,
    other columns are not read, an empty table gives a table without files. The files are written by Spark's own
    committer, so that a lost executor's tasks are simply run again.
    """
    spark = docs.sparkSession
    rows = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), as_text(F.col("text")).alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("crc", F.crc32(F.encode("text", "UTF-8"))).repartitionByRange(n, "id", "crc").sortWithinPartitions("id", "crc", "text")
    rows.mapInArrow(lambda it: _write_batches(it, vocabulary, end_id), FILE_SCHEMA).write.parquet(path)


def _read_batches(batches):
    for batch in batches:
        for first, data in zip(batch["start"].to_pylist(), batch["data"]):
            docs, lengths, ids = read_file(data.as_py())
            raw = memoryview(ids.astype("<u4").tobytes())
            ends = np.cumsum(lengths)
            starts = ends - lengths
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(starts + first), pa.array(lengths), pa.array(crc, pa.int64())],
                                             ["id", "start", "n_tokens", "ids_crc32"])


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """The files with ``start``, the number of ids before each in all. One row per part passes through the driver."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    sums = sorted(files.groupBy("part").agg(F.sum("ids").alias("n")).collect())
    before, rows = 0, []
    for part, n in sums:
        rows.append((part, before))
        before += n
    parts = spark.createDataFrame(rows, "part int, before long")
    return files.join(F.broadcast(parts), "part").withColumn("start", F.col("before") + F.col("first"))


def read_digests(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """id_col, start (ids of all documents before), n_tokens and ids_crc32 of every document in the files at ``path``.
    Raises an error if a file's header or a block doesn't meet its checksum."""
    out = _placed(spark, path).select("start", "data").mapInArrow(_read_batches, "id long, start long, n_tokens long, ids_crc32 long")
    return out.withColumnRenamed("id", id_col)


def read_ids(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """id_col and the array of ids of every document in the files at ``path``."""
    def read(batches):
        for batch in batches:
            for data in batch["data"]:
                docs, lengths, ids = read_file(data.as_py())
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))], ["id", "ids"])

    return spark.read.schema(FILE_SCHEMA).parquet(path).select("data").mapInArrow(read, "id long, ids array<int>").withColumnRenamed("id", id_col)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_vocabulary("word_bpe_49k.json"))
    return read_digests(spark, path)
