"""PPM and unigram scores against brute force, and held-out quality."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import SF001, SF01
from tidecast.llm import lm
from tidecast.llm.lm import END, LOW, SYMBOLS, Trie, _leaves, adaptive_score, op3_ppm_scores, ppm_scores


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def slow(rows, order=5):
    """Base and PPM of (id, text) rows by plain loops over dictionaries."""
    train = [t for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1]
    words = Counter()
    trie = {}
    for t in train:
        words.update([*lower(t).encode().split(), "end"])
        b = [*t.encode(), END]
        for i, s in enumerate(b):
            for k in range(min(order, i) + 1):
                trie.setdefault(tuple(b[i - k:i]), Counter())[s] += 1
    n, v = sum(words.values()), len(words)
    out = []
    for i, t in rows:
        tokens = [*lower(t).encode().split(), "end"]
        base = sum(math.log10((words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        b, score = [*t.encode(), END], 0.0
        for j, s in enumerate(b):
            out_of = set()
            for k in range(min(order, j), -1, -1):
                c = trie.get(tuple(b[j - k:j]), {})
                rest = {x: m for x, m in c.items() if x not in out_of}
                esc = len(rest) if len(c) < SYMBOLS else 0
                if s in rest:
                    score += math.log10(rest[s] / (sum(rest.values()) + esc))
                    break
                if rest:
                    score += math.log10(esc / (sum(rest.values()) + esc))
                out_of |= set(c)
            else:
                score -= math.log10(SYMBOLS - len(out_of))
        out.append((i, zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1, len(tokens), sum(words[w] > 0 for w in tokens), n, base, score))
    return out


def near(got, want):
    key = lambda r: (str(r[0]), r[2], r[3], round(r[6], 1))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-5, abs=1e-5)


@pytest.mark.parametrize("order,segment_leaves", [(5, 4_000_000), (5, 3000), (4, 20_000), (3, 100), (2, 10), (1, 10), (0, 10)])
def test_equals_brute_force(spark, order, segment_leaves, monkeypatch):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()][:40]
    rows += [(1000, ""), (1001, ""), (1002, "  A a\tÀ"), (1003, "\x00\x01 \x7f"), (None, "a b"), (None, "a b"), (2, rows[2][1])]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n long, word string").repartition(4)
    near(ppm_scores(df, order=order, segment_leaves=segment_leaves).collect(), slow(rows, order))


def build(texts, order):
    sums = [lm._Sums() for _ in range(order + 1)]
    for k, codes in _leaves(texts, order):
        sums[k].add(codes)
    parts = [(np.full(len(c), k), c, n) for k, (c, n) in enumerate(s.total() for s in sums)]
    high = [np.concatenate(x) for x in zip(*parts)]
    cut = [(np.minimum(o, LOW), c % SYMBOLS ** (min(k, LOW) + 1), n) for k, (o, c, n) in enumerate(parts)]
    return Trie(order, [np.concatenate(x) for x in zip(*cut)], high)


@pytest.mark.parametrize("order", [0, 2, 3, 5])
def test_probabilities_add_up(order):
    """Over all symbols the shares in any context add up to one, as the contexts' first bytes are known or not."""
    rng = np.random.default_rng(0)
    texts = [bytes(rng.choice(list(b"abcd \xc3\xa9"), n).tolist()) for n in (400, 30, 0, 1, 7)]
    trie = build(texts, order)
    for context in (b"", b"a", b"ab", b"abc", b"abcda", b"zzabc", b"\xffa", texts[0][:5], texts[0][100:105]):
        context = context[:order]
        codes = np.arange(SYMBOLS) + sum(b * SYMBOLS ** (j + 1) for j, b in enumerate(reversed(context)))
        cost = trie.costs(codes, np.full(SYMBOLS, len(context)))
        assert np.sum(10.0 ** cost) == pytest.approx(1, abs=1e-5)


def test_long_texts_in_pieces(monkeypatch):
    rng = np.random.default_rng(1)
    texts = [bytes(rng.choice(list(b"abc d"), n).tolist()) for n in (5, 0, 300, 41, 40, 39, 1000, 3)]
    whole = build(texts, 4)
    want = whole.score(texts)
    monkeypatch.setattr(lm, "STEP", 40)
    assert build(texts, 4).score(texts) == pytest.approx(want)
    parts = sum(whole.score(texts, i, 3) for i in range(3))
    assert parts == pytest.approx(want)


def test_adaptive_learns():
    assert adaptive_score(b"") == pytest.approx(-math.log10(257))
    assert adaptive_score(b"abcabc" * 50) > 5 * adaptive_score(b"abcabc") * 50 / 20
    assert adaptive_score(b"the cat " * 40) / 320 > adaptive_score(bytes(range(64, 128)) * 5) / 320


def test_held_out_quality(spark):
    got = [r for r in op3_ppm_scores(spark, SF01).collect() if r.held_out]
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    size = sum(len(docs[r.doc_id].encode()) + 1 for r in got)
    bits = -sum(r.score for r in got) * math.log2(10) / size
    assert bits < 2.7  # order 0 needs about 4.3 bits a byte on these texts, order 2 about 2.7


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, None), (None, None), (9, "z" * 300_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in ppm_scores(df).collect()}
    assert got[1].n_tokens == 1 and got[9].n_tokens == 2
    assert ppm_scores(df.limit(0)).count() == 0


def test_words_of_held_out_texts_only(spark, monkeypatch):
    """A word repeated in held-out texts alone is one row for each text, or broadcast; the results stay the same."""
    import pyarrow as pa
    monkeypatch.setattr(lm, "_trie", lambda key, sent: (build([b"a"], 1), {}))
    batch = pa.RecordBatch.from_pydict({"id": [1], "text": ["zq " * 1000 + "b"], "same": [0]})
    out = next(lm._score_batches([batch], 0, None, 1, 5, 1))
    assert sorted(out["rare"].to_pylist()[0]) == [(b" ", 1), (b"b", 1), (b"zq", 1000)]
    monkeypatch.undo()
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1]
    rows = [(i, f"the cat {i} sat " + ("zq qz " * 50 if i in held else "the")) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for most in (1, 20, 1 << 19):
        monkeypatch.setattr(lm, "HOT", most)
        near(ppm_scores(df, order=2).collect(), slow(rows, 2))
    counted = spark.createDataFrame([(-1, b"the", 90), (-1, b"cat", 1), (-2, b"zq", 80), (-2, b"cat", 20)], "ord int, word binary, n long")
    monkeypatch.setattr(lm, "HOT", 2)
    assert lm.frequent_words(counted, 91, 100) == {b"the": pytest.approx(math.log10(90.5)), b"zq": lm.UNKNOWN}
    monkeypatch.setattr(lm, "HOT", 10)
    assert lm.frequent_words(counted, 91, 100)[b"cat"] == pytest.approx(math.log10(1.5))


def test_trie_in_little_memory():
    """Building a trie takes a bounded number of bytes a leaf, beside the leaves given."""
    import tracemalloc
    rng = np.random.default_rng(0)
    codes = np.unique(rng.integers(0, SYMBOLS**2, 300_000) * SYMBOLS**4 + rng.integers(0, 5000, 300_000))
    high = [np.full(len(codes), 5, np.int8), codes, np.ones(len(codes), np.int32)]
    low = [np.full(len(codes), LOW, np.int8), codes % SYMBOLS**3, np.ones(len(codes), np.int32)]
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        trie = Trie(5, low, high)
        held, most = (x - before for x in tracemalloc.get_traced_memory())
    finally:
        tracemalloc.stop()
    assert held < 90 * len(codes) and most < 125 * len(codes), (held / len(codes), most / len(codes))
    assert len(trie.levels) == 6


def test_batches_in_pieces(monkeypatch):
    """A batch is counted and scored in slices of bounded size; the results are those of the whole."""
    import pyarrow as pa
    trie = build([b"the cat sat on the mat"], 3)
    monkeypatch.setattr(lm, "_trie", lambda key, sent: (trie, {}))
    texts = ["the cat", "", "sat " * 30, "é" * 70, "mat", "", "on the"]
    batch = pa.RecordBatch.from_pydict({"id": list(range(7)), "text": texts, "same": list(range(7))})
    run = lambda: (list(lm._score_batches([batch, batch.slice(0, 0)], 0, None, 2, 5, 1)), list(lm._add_batches([batch], 0, None, 1, 2)))
    whole = [pa.Table.from_batches(x).to_pydict() for x in run()]
    counted = Counter()

    def count():
        out = Counter()
        for b in lm._count_batches([batch], 3, 5, 1):
            for *key, n in zip(*(b[c].to_pylist() for c in ("ord", "code", "word", "n"))):
                out[tuple(key)] += n
        return out

    counted = count()
    monkeypatch.setattr(lm, "PIECE", 40)
    cut = run()
    assert all(len(x) > 3 and max(b.num_rows for b in x) < 5 for x in cut)
    assert [pa.Table.from_batches(x).to_pydict() for x in cut] == whole and len(whole[0]["id"]) == 7
    assert count() == counted
    monkeypatch.setattr(lm, "FLUSH", 2)
    assert count() == counted
