"""License scans against brute force."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF001
from tidecast.llm.license import PHRASES, TEMPLATES, Scanner, compile_template, license_scan, op6_license_scan, words_of

SCAN = Scanner(PHRASES, TEMPLATES)


def slow_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def slow_base(text):
    w = slow_words(text)
    return sorted((label, i) for p, label in PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split())


def as_regex(template):
    """A template as a regular expression over words that each end in one space."""
    out = ""
    for mark, n, word in re.findall(r"(<<optional>>|<</optional>>|<<var: *(\d+)>>)|(\S+?)(?=\s|<<|$)", template):
        out += "(?:" if mark == "<<optional>>" else ")?" if mark == "<</optional>>" else f"(?:[^ ]+ ){{0,{n}}}" if mark else re.escape(word) + " "
    return out


PIECES = st.lists(st.sampled_from(["cc by", "CC-BY-nc 4.0", "cc", "by", "General public LICENSE", "all rights reserved.", "é", "\x00", "is",
                                   "licensed under the", "GNU", "lesser", "general public license", "version 3", "apache license, version 2.0",
                                   "mit license", "released under the", "terms of the", "this work", "Ä", "2 0", "x1"])).map(" ".join)


@given(st.one_of(st.text(), PIECES))
@settings(max_examples=400, deadline=None)
def test_base_and_templates(text):
    n, base, spans = SCAN.scan(text.encode())
    words = slow_words(text)
    assert n == len(words) and sorted(base) == slow_base(text)
    line = "".join(w + " " for w in words)
    for label, t in TEMPLATES.items():
        own = [s for s in spans if s[0] == label]
        assert bool(own) == bool(re.search(r"(?:^|(?<= ))" + as_regex(t), line)), label
        for _, a, b in own:
            assert re.fullmatch(as_regex(t), "".join(w + " " for w in words[a:b]))


def test_mandatory_wording_is_exact():
    full = re.sub(r"<<[^>]*>>", " ", TEMPLATES["mit"])
    assert "mit" in {s[0] for s in SCAN.scan(full.encode())[2]}
    assert "mit" not in {s[0] for s in SCAN.scan(full.replace("free of charge", "free of cost").encode())[2]}
    named = "Copyright (c) 2020 Some Body\n\n" + full[full.index("permission"):]
    assert [s for s in SCAN.scan(named.encode())[2] if s[0] == "mit"][0][1] == 0


@pytest.mark.parametrize("label", sorted(TEMPLATES))
def test_any_changed_mandatory_word_rejects_the_template(label):
    """Every mandatory word in turn, with all optional parts left out and regions filled with one word."""
    bare = TEMPLATES[label]
    while "<<optional>>" in bare:
        bare = re.sub(r"<<optional>>(?:(?!<</?optional>>).)*<</optional>>", " ", bare, flags=re.S)
    words = [(w, True) for w in re.sub(r"<<var: *\d+>>", " @ ", bare).split()]
    words = [("filler", False) if w == "@" else (w, m) for w, m in words]
    scan = Scanner({}, {label: TEMPLATES[label]}).scan
    assert [s[1:] for s in scan(" ".join(w for w, _ in words).encode())[2]] == [(0, len(words))]
    for i, (_w, mandatory) in enumerate(words):
        if mandatory:
            assert not scan(" ".join([w for w, _ in words[:i]] + ["zebra"] + [w for w, _ in words[i + 1:]]).encode())[2], i


def test_two_and_three_clauses_are_told_apart():
    plain = lambda label: re.sub(r"<<var[^>]*>>", "the copyright holder", re.sub(r"<</?optional>>", " ", TEMPLATES[label]))
    for label in ("bsd-2-clause", "bsd-3-clause", "mit", "isc", "zlib", "unlicense"):
        assert {s[0] for s in SCAN.scan(plain(label).encode())[2]} == {label}


def test_bad_templates():
    for t in ["<<optional>> a", "a <</optional>>", "<<optional>>a<</optional>>", ""]:
        with pytest.raises(ValueError):
            compile_template("x", t)


def test_query(spark):
    got = {r.doc_id: r for r in op6_license_scan(spark, SF001).collect()}
    for r in spark.read.parquet(f"{SF001}/documents.parquet").collect():
        base, g = slow_base(r.text), got[r.doc_id]
        starts = [i for _, i in base]
        labels = {label for label, _ in base}
        assert (g.n_words, g.n_base, g.first_word, g.last_word) == (len(slow_words(r.text)), len(base), min(starts, default=None), max(starts, default=None))
        assert g.base_labels == ",".join(sorted(labels)) and labels <= set(filter(None, g.labels.split(","))) and 0 <= g.score <= 1


def test_planted_notices():
    labels = lambda t: {s[0] for s in SCAN.scan(t.encode())[2]}
    assert labels("This work is licensed under the GNU General Public License, version 3.") == {"gpl-notice"}
    assert labels("Released under the MIT License.") == {"mit-notice"}
    assert labels("Licensed under the Apache License, Version 2.0.") == {"apache-notice"}
    assert labels("Licensed under CC BY-NC 4.0.") == {"cc-by-nc"}


def test_nulls_repeats_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, "cc by cc by", "a"), (None, "cc by cc by", "a"), (2, "cc by " * 50_000, None)],
                               "doc_id long, text string, labels string")
    got = sorted((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.score) for r in license_scan(df).collect())
    assert got == [("1", 0, 0, None, None, 0.0), ("2", 100_000, 50_000, 0, 99_998, 1.0), ("None", 4, 2, 0, 2, 1.0), ("None", 4, 2, 0, 2, 1.0)]
    assert license_scan(df.limit(0)).count() == 0
