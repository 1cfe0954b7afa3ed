"""Cross-tokenizer alignment against a plain recomputation; galloping; both ways of A's library."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from tidecast.llm import align
from tidecast.llm.bpe import byte_letters, public_vocabulary

A, B = public_vocabulary(), public_vocabulary("piece_bpe_32k.model")
COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def expected(rows):
    import sentencepiece
    tok, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    letters = byte_letters()
    piece = lambda i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
    docs, counts = [], Counter()
    for i, text in rows:
        found, groups = [], []
        if text:
            e, b = tok.encode(" " + text, add_special_tokens=False), sp.encode(text)
            spans = []
            for ids, parts in ((e.ids, [bytes(letters[c] for c in t) for t in e.tokens]), (b, [piece(x) for x in b])):
                at, own = 0, []
                for x, p in zip(ids, parts):
                    own.append((x, at, at + len(p)))
                    at += len(p)
                spans.append((own, b"".join(parts)))
            if all(s[1] == (" " + text).encode() for s in spans):
                common = {s[2] for s in spans[0][0]} & {s[2] for s in spans[1][0]}
                found = [(x, y) for x, s, t in spans[0][0] for y, u, v in spans[1][0] if s < v and u < t] if len(text) < 5000 else None
                for side in (0, 1):
                    now, out = [], []
                    for x, _, t in spans[side][0]:
                        now.append(str(x))
                        if t in common:
                            out.append(",".join(now))
                            now = []
                    groups.append(out)
                n = len(spans[0][0]), len(spans[1][0])
                counts.update(found)
        docs.append((i, *(n if groups else (0, 0)), list(zip(*groups)) if groups else [], found))
    best = Counter()
    for (x, y), c in counts.items():
        best[y] = max(best[y], c)
    out = []
    for i, na, nb, groups, found in docs:
        text = ";".join(f"{x}|{y}" for x, y in groups)
        out.append((i, na, nb, len(groups), len(found), sum(counts[p] == best[p[1]] for p in found), sum(counts[p] for p in found),
                    sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


def run(spark, rows, chars=align.BLOCK_CHARS, extra=()):
    df = spark.createDataFrame([tuple(r) + extra for r in rows], "doc_id long, text string" + (", block long, n_a string" if extra else ""))
    got = align.align(df.repartition(3), A, B, with_groups=True, chars=chars)
    for r in got.collect():
        assert r.groups_sha256 == (sha256(r.groups.encode()).hexdigest() if r.groups else "")
    return sorted(map(tuple, got.select(*COLS).collect()), key=str)


ODD = ["", None, "a", " ", "\n\n", "▁a b", "a▁", "<|endoftext|> <s> </s> <unk>", "日本語のテキスト 𬎡", "é​x", "naïve café ÅÄÖ", "\x00\x01", "12 345,6",
       "Ελληνικά και русский", "don't we'll I'm", "a  b   c\t\td ", "x" * 400, "ab" * 700, "<0x41>", "👩‍👩‍👧 ok", " lead", "trail  "]


@pytest.mark.parametrize("chars", [1, 40, 1 << 22])
def test_odd_texts_ties_and_repeated_rows(spark, chars):
    rows = list(enumerate(ODD)) + [(None, "the same text"), (900, "the same text"), (900, "the same text"), (901, None)]
    assert run(spark, rows, chars, (5, "x")) == expected(rows)


def test_query_on_given_documents(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r.values()) for r in pq.read_table(f"{d}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    short = [(i, t if len(t or "") < 4000 else t[:4000]) for i, t in rows]
    assert run(spark, short, 20_000) == expected(short)
    got = {r.doc_id: r for r in align.op11_token_alignment(spark, d).collect()}
    whole = align.Aligner(A, B)
    for i, text in rows:
        a, b = whole.tokens([text])[0]
        assert (got[i].n_a, got[i].n_b, got[i].n_links) == (len(a), len(b), len(a) + len(b) - got[i].n_groups)


def test_empty_table_and_a_very_long_text(spark):
    assert run(spark, []) == []
    got = run(spark, [(1, "word " * 200_000)])
    assert got[0][1] == got[0][3] + got[0][4] - got[0][2] and got[0][1] > 200_000


def test_gallop_equals_a_plain_search():
    rng = random.Random(3)
    for _ in range(200):
        shorts, longs = [], []
        for _ in range(rng.randint(1, 6)):
            top = rng.randint(1, 400)
            ends = [sorted({*rng.sample(range(1, top + 1), rng.randint(0, min(top, rng.choice([2, 40, 400])))), top}) for _ in (0, 1)]
            ends.sort(key=len)
            shorts.append(ends[0])
            longs.append(ends[1])
        base, s, t = 0, [], []
        for x, y in zip(shorts, longs):
            s += [base + v for v in x]
            t += [base + v for v in y]
            base += x[-1]
        n, m = np.array([len(x) for x in shorts]), np.array([len(x) for x in longs])
        got = align.gallop(np.array(s), n, np.array(t), np.cumsum(m) - m, m)
        assert got.tolist() == np.searchsorted(t, s).tolist()


def test_both_libraries_agree_on_every_token_and_every_latin_character():
    a = align.ByteLevel(A)
    assert a.fast is not None
    for t in a.bytes:
        try:
            text = t.decode()
        except UnicodeDecodeError:
            continue
        if not a.foreign(text):
            assert a.fast.encode_ordinary(text) == a.slow.encode(text, add_special_tokens=False).ids, text
    for c in map(chr, range(1, 0x370)):
        for text in (f"a{c}b 1{c}2", f" {c} {c}{c}.{c}. a {c}", f"{c}\n{c} x'{c}s {c}'s"):
            assert a.encode(text) == a.slow.encode(text, add_special_tokens=False).ids, repr(c)


def test_blocks_are_made_in_pieces(monkeypatch):
    """No more than a piece of a block is tokenized at once; its links and counts are those of the whole."""
    import pyarrow as pa
    import zstandard
    from types import SimpleNamespace
    texts = [*ODD, "the cat", "the cat", "", "the the " * 9, "cat 12 é" * 3]
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": texts})
    aligner, asked = align.Aligner(A, B), []
    plain = aligner.tokens
    aligner.tokens = lambda texts: asked.append(sum(len(t or "") for t in texts)) or plain(texts)
    monkeypatch.setattr(align, "_aligner", lambda *paths: aligner)
    monkeypatch.setattr(align, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))

    def block():
        (row,) = (b.to_pylist()[0] for b in align._block_batches([batch.slice(0, 7), batch.slice(7)], A, B, True, 1 << 22))
        codes = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["codes"]), np.uint32)
        pairs, ends = np.array(row["keys"])[codes], np.cumsum(row["n_links"])
        docs = {i: (*(row[c][k] for c in ("n_a", "n_b", "n_groups", "sha", "groups")), pairs[ends[k] - row["n_links"][k]:ends[k]].tolist())
                for k, i in enumerate(row["doc"])}
        assert row["counts"] == sorted(row["counts"], reverse=True)
        return docs, dict(zip(row["keys"], row["counts"]))

    whole = block()
    assert len(whole[0]) == len(texts) and sum(whole[1].values()) == sum(len(x[-1]) for x in whole[0].values())
    monkeypatch.setattr(align, "PIECE_CHARS", 30)
    asked.clear()
    assert block() == whole
    assert len(asked) > 5 and max(asked) <= 30 + 1400
    assert sum(n > 100 for n in asked) == 2  # a long text is one piece, with the few before it
