"""Quality rules against brute force."""

import random
import re
from collections import Counter

import pytest

from conftest import SF01
from tidecast.llm.quality import RULES, STOP_WORDS, Rule, keep_clean, op7_quality_rules, quality


def slow(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    times = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if times[x] > 1 for k in range(5)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_bangs": text.count("!"),
            "n_stop": sum(x.lower() in STOP_WORDS for x in w), "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)),
            "n_bullets": sum(x.startswith(("- ", "* ", "• ")) for x in lines), "n_ellipses": sum(x.endswith(("...", "…")) for x in lines),
            "n_repeat_words": len(covered), "one": 1}


def breaks(m, rules=RULES):
    return [r.name for r in rules if m["n_words"] >= r.from_words and (
        r.at_least is not None and 100 * m[r.over] < r.at_least * m[r.under] or r.at_most is not None and 100 * m[r.over] > r.at_most * m[r.under])]


def random_texts():
    rng = random.Random(5)
    bits = ["the", "A", "é", "日本", "🙂x", "#", "a|b", "\n", "\n\n", "\t", "\x0b", "- ", "...", "…\n", "!!", "\x1c", " ", "of", "x y z u v", "\r"]
    return [rng.choice(["", " "]).join(rng.choice(bits) + " " * rng.randint(0, 2) for _ in range(rng.randint(0, 80))) for _ in range(250)]


def test_equals_brute_force(spark):
    texts = random_texts() + [None, "", " ", "a b c d e a b c d e", "a a a a a a a", "a a a a a", "w " * 30_000, "x\nx\nx"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.asDict() for r in quality(df).collect()}
    for i, t in enumerate(texts):
        m = slow(t)
        assert {k: got[i][k] for k in m if k != "one"} == {k: v for k, v in m.items() if k != "one"}, t
        assert got[i]["broken"] == breaks(m) and got[i]["kept"] == (not breaks(m))


def test_query_keeps_clean_documents(spark):
    got = {r.doc_id: r for r in op7_quality_rules(spark, SF01).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    assert all(got[i].kept or got[i].base_failed for i, q in labels.items() if q == 1)
    assert sum(got[i].kept for i, q in labels.items() if q == 0) <= 0.1 * sum(q == 0 for q in labels.values())


def test_rules_with_one_bound(spark):
    df = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    rules = (Rule("x", "n_words", "one", at_least=500), Rule("y", "n_words", "one", at_most=300), Rule("z", "n_words", "one", at_least=500, from_words=5))
    assert quality(df, rules=rules).first().broken == ["x", "y"]


def test_nulls_repeats_clashing_columns(spark):
    good = "the cat sat on the mat and looked at all of the birds there"
    df = spark.createDataFrame([(1, None, 3, "x"), (None, good, 4, None), (None, good, 4, None)], "doc_id long, text string, n_words int, m string")
    assert [(r.doc_id, r.n_words, r.kept) for r in quality(df).orderBy("n_words").collect()] == [(1, 0, False), (None, 14, True), (None, 14, True)]
    kept = keep_clean(df)
    assert kept.columns == df.columns and [tuple(r) for r in kept.collect()] == [(None, good, 4, None)] * 2
    assert quality(df.limit(0)).count() == 0 and keep_clean(df.limit(0)).count() == 0


@pytest.mark.parametrize("word", ["PythonUDF", "ArrowEval", "BatchEval", "Exchange", "MapIn"])
def test_one_projection(spark, word):
    assert word not in op7_quality_rules(spark, SF01)._jdf.queryExecution().executedPlan().toString()


def test_other_languages_need_no_stop_words(spark):
    prose = " ".join(f"sana{i}" for i in range(200))
    langs = ["fi", "en", "FR", "de-AT", None, "sv-SE"]
    df = spark.createDataFrame([(i, prose, x) for i, x in enumerate(langs)] + [(9, "short", "fi")], "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in keep_clean(df).collect()) == [0, 4, 5]
    assert keep_clean(df.drop("lang")).count() == 0
