"""Token files: exact round trips, checksums, equality with the tokenizers library."""

import string
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF001
from tidecast.llm import codec
from tidecast.llm.bpe import public_vocabulary
from tidecast.llm.codec import read_block, read_file, write_file
from tidecast.llm.tokenfiles import ChunkIds, op9_token_files, read_digests, read_ids, write_token_files
from tidecast.session import shared_path

PATH = public_vocabulary("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
CHUNKS = ChunkIds(PATH, most=500)


@given(st.lists(st.integers(0, codec.MOST - 1), max_size=700), st.integers(0, 3))
@settings(max_examples=60, deadline=None)
def test_round_trip(ids, repeat):
    ids = np.array(ids * (1 + repeat), np.int32)
    docs, lengths, back = read_file(write_file([3, None, -5], np.array([len(ids), 0, 0]), ids))
    assert docs == [3, None, -5] and lengths.tolist() == [len(ids), 0, 0] and (back == ids).all()


@pytest.mark.parametrize("kind", ["constant", "cycle", "text", "random", "ends"])
def test_blocks_and_lanes(kind, monkeypatch):
    monkeypatch.setattr(codec, "LANES", 7)
    rng = np.random.default_rng(4)
    n = 9000
    ids = {"constant": np.full(n, 17), "cycle": np.arange(n) % 13, "text": np.minimum(rng.zipf(1.2, n) - 1, 49_000),
           "random": rng.integers(0, codec.MOST, n), "ends": np.where(np.arange(n) % 2, codec.MOST - 1, 0)}[kind].astype(np.int32)
    data = write_file([1], np.array([n]), ids)
    assert (read_file(data)[2] == ids).all()
    size = codec.block_size(n)
    for b in (0, 3, -(-n // size) - 1):
        assert (read_block(data, b) == ids[b * size:(b + 1) * size]).all()
    if kind in ("constant", "cycle"):
        assert len(data) < n / 2
    bad = bytearray(data)
    bad[-40] ^= 1
    with pytest.raises(ValueError):
        read_file(bytes(bad))
    bad = bytearray(data)
    bad[30] ^= 1
    with pytest.raises((ValueError, zlib.error)):
        read_file(bytes(bad))


@given(st.one_of(st.text(), st.lists(st.sampled_from(["Hello,", "don't", "<|endoftext|>", "é", "É.", "ΣΑΣ", "İ", "́", " ", "\x1c", "\x85", "12", "..", ".a,", "漢字",
                                                     "🙂", "word's", "''s", "A.B.", "…", " ", "x" * 70])).map("".join)))
@settings(max_examples=500, deadline=None)
def test_chunks_equal_library(text):
    assert np.frombuffer(CHUNKS.ids(text), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def expected(rows):
    at, out = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()), r[1] or "")):
        ids = np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert sorted(map(tuple, op9_token_files(spark, SF001).collect())) == expected(rows)


def test_nulls_repeats_clashing_columns(spark):
    rows = [(5, "b c"), (None, "a"), (None, None), (5, "b c"), (5, "a"), (1, ""), (9, "long " * 60_000), (2, "x" * 100_000)]
    df = spark.createDataFrame([(i, t, "q", 1) for i, t in rows], "doc_id long, text string, part string, ids int").repartition(4)
    path = shared_path(spark, "t")
    write_token_files(df, path, PATH)
    got = sorted(map(tuple, read_digests(spark, path).collect()), key=lambda r: r[1])
    assert got == expected(rows)
    ids = sorted(len(r.ids) for r in read_ids(spark, path).collect())
    assert ids == sorted(r[2] for r in got)
    write_token_files(df.limit(0), path + "e", PATH)
    assert read_digests(spark, path + "e").count() == 0


def test_tails_equal_library():
    for word in ("word", "Dés", "a1", "don't", "İ", "漢", "x" * 63):
        for a in string.punctuation:
            for b in ("", a, "...", "'s", ")"):
                text = word + a + b
                assert np.frombuffer(CHUNKS.ids(text), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids, text


def test_order0_reaches_entropy():
    """Ids without any order cost about their plain entropy, though no block knows another."""
    rng = np.random.default_rng(5)
    ids = np.minimum(rng.zipf(1.3, 60_000) - 1, 40_000).astype(np.int32)
    share = np.bincount(ids) / len(ids)
    entropy = -(share[share > 0] * np.log2(share[share > 0])).sum()
    bits = 8 * (len(write_file([1], np.array([len(ids)]), ids)) - len(codec.Table.of(ids).pack())) / len(ids)
    index = 8 * codec._BLOCK.itemsize / codec.block_size(len(ids))  # what each block's entry adds per id
    assert bits < entropy + index + 0.4


def test_words_go_to_the_model_directly():
    """A Latin word takes no access to the tokenizer's objects, and has the library's ids, as long lists of ids have."""
    texts = ["the Cat SAT, thereupon;", "été Ünder ŒUVRE", "zq" * 30 + " " + "Xylo" * 16]
    odd = ["it's IT'S a1b2 İx ﬁ x́y 日本", "é" * 90, "a" * 300, "1" * 200]
    want = [np.array(LIBRARY.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts + odd]
    chunks = ChunkIds(PATH)
    assert [chunks.ids(t) for t in texts + odd] == want
    chunks = ChunkIds(PATH)
    for tail in (",", ";"):
        chunks.ids(tail)
    chunks.tokenizer = None
    assert [chunks.ids(t) for t in texts] == want[:3]


def test_capitals_are_no_chunks_of_their_own():
    chunks = ChunkIds(PATH)
    for text in ("The the THE, tHe,", "Été ÉTÉ été ÐÞ ðþ"):
        assert np.frombuffer(chunks.ids(text), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert {"The", "THE", "ÉTÉ"}.isdisjoint(chunks) and {"the", "été", "ðþ"} <= set(chunks)
    for a in map(chr, range(256)):
        for text in (a, f"x{a}", f"{a}X", f"Á{a}É", f"{a}\u0301 J\u030c", f"ΑΣ{a}"):
            assert np.frombuffer(chunks.ids(text), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids, repr(text)


def test_places_in_16_bits():
    """Files with few distinct ids look them up in half the memory; those with more keep theirs."""
    for n, kind in ((1 << 16, np.uint16), ((1 << 16) + 1, np.int32)):
        ids = np.arange(n, dtype=np.int32)[::-1] * 2
        table = codec.Table.of(ids)
        assert table.by_part().dtype == kind and len(table.by_part()) == 1 << codec.PARTS
        assert (read_file(write_file([1], np.array([n]), ids))[2] == ids).all()


def test_badly_predicted_ids_get_more_room():
    table = codec.Table(np.arange(5000) * 3, codec.shares(np.where(np.arange(5000) == 7, 10**9, 1)))
    rng = np.random.default_rng(6)
    n = np.array([2048, 2048, 1999, 70])
    x = np.where(np.arange(4) == 1, 7, rng.integers(0, 5000, (2048, 4))).astype(np.int32)
    words, used = codec._encode_lanes(x, n, table)
    assert used[0] > 2048 // 2 + 96 and used[1] < 40
    got = codec._decode_lanes(words, n, 2048, table)
    for lane in range(4):
        assert (got[lane, :n[lane]] == 3 * x[:n[lane], lane]).all()


def test_files_stay_the_same():
    """Files of this format that are already written are still read, and written again to the byte."""
    rng = np.random.default_rng(7)
    ids = np.minimum(rng.zipf(1.2, 400_000) - 1, 49_000).astype(np.int32)
    ids[100_000:200_000] = ids[:100_000]
    data = write_file([3, None, 5], np.array([10, 0, len(ids) - 10]), ids)
    blocks = data[int(codec._head(data)[-1][0]):]  # what comes before is packed by zlib, whose versions differ
    assert (len(blocks), zlib.crc32(blocks)) == (379504, 1952579621)
