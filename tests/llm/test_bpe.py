"""BPE round trip against the tokenizers library."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF001
from tidecast.llm.bpe import Encoder, Vocabulary, encode_decode, op2_bpe_roundtrip, public_vocabulary

PATH = public_vocabulary()
LIBRARY = Tokenizer.from_file(PATH)
CODER = Encoder(Vocabulary(PATH))


def ids(text):
    return np.frombuffer(CODER.encode(text), "<u4").tolist()


def same(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert ids(text) == want
    assert CODER.decode(np.array(want, np.uint32)).decode("utf-8", "replace") == LIBRARY.decode(want, skip_special_tokens=False)


@given(st.one_of(st.text(), st.text("aeinrst 'd\n"), st.text("ab"), st.lists(st.sampled_from(
    ["<|endoftext|>", "<|", " ", "\n\n", "\t", "don't", "1234567", "éà", "漢字", "🙂", "\x1c", "\x85", " ", "ſ", "²", "the", " the"])).map("".join)))
@settings(max_examples=600, deadline=None)
def test_equals_library(text):
    same(text)


@pytest.mark.parametrize("text", ["", "a" * 5000, "ab" * 3000, "the" * 2000, " " * 3000, "é" * 2000, "　 x", "".join(map(chr, range(1, 0x3000)))])
def test_long_and_odd(text):
    same(text)


def test_every_character_class(spark):
    text = "".join(f"a{chr(c)}1{chr(c)} {chr(c)}." for c in range(0x20, 0x30000, 7) if not 0xD800 <= c < 0xE000)
    same(text)


def test_merges_by_brute_force():
    def plain(word):
        rank = {p: CODER.v.pair[p] for p in CODER.v.pair}
        parts = list(word)
        while len(parts) > 1 and (best := min((rank.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:]))))[0] < 1 << 60:
            parts[best[1]:best[1] + 2] = [best[0]]
        return parts
    rng = np.random.default_rng(0)
    for _ in range(300):
        word = bytes(rng.choice(list(b"aeinorst th"), rng.integers(1, 30)).tolist())
        assert CODER.ranks(word) == plain(word)


def test_query(spark):
    got = {r.doc_id: r for r in op2_bpe_roundtrip(spark, SF001).collect()}
    rows = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        want = LIBRARY.encode(r.text or "", add_special_tokens=False).ids
        g = got[r.doc_id]
        assert g.n_tokens == len(want)
        assert g.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert g.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_nulls_repeats_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, 5, "q"), (None, "a b", 6, None), (1, None, 5, "q"), (2, "x" * 200_000, None, "")],
                               "doc_id long, text string, id int, n_tokens string")
    out = encode_decode(df, PATH).collect()
    assert sorted((str(r.doc_id), r.n_tokens > 0, r.decoded or "") for r in out) == sorted(
        [("1", False, ""), ("1", False, ""), ("None", True, "a b"), ("2", True, "x" * 200_000)])
    assert encode_decode(df.limit(0), PATH).count() == 0
