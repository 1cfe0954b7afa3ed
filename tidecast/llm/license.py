"""License scans by template-markup matching.

A template is license wording with markup: ``<<optional>> ... <</optional>>`` may be missing as a whole,
``<<var: n>>`` stands for up to n words of any kind. Templates are compiled into automata over words; a place in a
text matches if the words from there on are the mandatory wording exactly, with optional parts present or absent and
replaceable regions filled. Beside the templates, plain phrases are looked for; they carry the labels of the base
contract.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import as_text, pick, table

# The phrases of the base contract and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Wording of public license texts and notices, with our markup.
TEMPLATES = {
    "mit": """<<optional>>the mit license <<optional>>mit<</optional>><</optional>> <<optional>>copyright <<optional>>c<</optional>> <<var: 20>><</optional>>
        permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
        the software to deal in the software without restriction including without limitation the rights to use copy modify merge
        publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do
        so subject to the following conditions the above copyright notice and this permission notice
        <<optional>>including the next paragraph<</optional>> shall be included in all copies or substantial portions of the software
        the software is provided as is without warranty of any kind express or implied including but not limited to the
        warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the <<var: 6>> be liable
        for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in
        connection with the software or the use or other dealings in the software""",
    "isc": """<<optional>>copyright <<optional>>c<</optional>> <<var: 20>><</optional>> permission to use copy modify and
        <<optional>>or<</optional>> distribute this software for any purpose with or without fee is hereby granted provided that the above
        copyright notice and this permission notice appear in all copies the software is provided as is and <<var: 6>> disclaims all
        warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall
        <<var: 6>> be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of
        use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with
        the use or performance of this software""",
    "bsd-2-clause": """redistribution and use in source and binary forms with or without modification are permitted provided that the
        following conditions are met <<optional>>1<</optional>> redistributions of source code must retain the above copyright notice
        this list of conditions and the following disclaimer <<optional>>2<</optional>> redistributions in binary form must reproduce
        the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials
        provided with the distribution this software is provided by <<var: 8>> as is and any express or implied warranties including
        but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event
        shall <<var: 8>> be liable for any direct indirect incidental special exemplary or consequential damages including but not
        limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and
        on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way
        out of the use of this software even if advised of the possibility of such damage""",
    "bsd-3-clause": """redistribution and use in source and binary forms with or without modification are permitted provided that the
        following conditions are met <<optional>>1<</optional>> redistributions of source code must retain the above copyright notice
        this list of conditions and the following disclaimer <<optional>>2<</optional>> redistributions in binary form must reproduce
        the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials
        provided with the distribution <<optional>>3<</optional>> neither the name of <<var: 8>> nor the names of its contributors may
        be used to endorse or promote products derived from this software without specific prior written permission this software is
        provided by <<var: 8>> as is and any express or implied warranties including but not limited to the implied warranties of
        merchantability and fitness for a particular purpose are disclaimed in no event shall <<var: 8>> be liable for any direct
        indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or
        services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract
        strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised
        of the possibility of such damage""",
    "zlib": """this software is provided as is without any express or implied warranty in no event will the authors be held liable for
        any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including
        commercial applications and to alter it and redistribute it freely subject to the following restrictions
        <<optional>>1<</optional>> the origin of this software must not be misrepresented you must not claim that you wrote the original
        software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not
        required <<optional>>2<</optional>> altered source versions must be plainly marked as such and must not be misrepresented as
        being the original software <<optional>>3<</optional>> this notice may not be removed or altered from any source distribution""",
    "unlicense": """this is free and unencumbered software released into the public domain anyone is free to copy modify publish use
        compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non
        commercial and by any means in jurisdictions that recognize copyright laws the author or authors of this software dedicate any
        and all copyright interest in the software to the public domain we make this dedication for the benefit of the public at large
        and to the detriment of our heirs and successors we intend this dedication to be an overt act of relinquishment in perpetuity of
        all present and future rights to this software under copyright law the software is provided as is without warranty of any kind
        express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and
        noninfringement in no event shall the authors be liable for any claim damages or other liability whether in an action of contract
        tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software""",
    "apache-2.0-header": """licensed under the apache license version 2 0 the license you may not use this file except in compliance
        with the license you may obtain a copy of the license at""",
    "apache-notice": """<<optional>>is<</optional>> <<optional>>released<</optional>> <<optional>>licensed<</optional>> under the
        <<optional>>terms of the<</optional>> apache license <<optional>>version<</optional>> 2 0""",
    "mit-notice": """<<optional>>released<</optional>> <<optional>>licensed<</optional>> <<optional>>distributed<</optional>> under the
        <<optional>>terms of the<</optional>> mit license""",
    "gpl-notice": """<<optional>>this <<var: 3>> is<</optional>> licensed under the <<optional>>terms of the<</optional>> gnu
        <<optional>>lesser<</optional>> <<optional>>affero<</optional>> general public license
        <<optional>><<optional>>either<</optional>> version <<var: 2>><</optional>>""",
    "gpl-header": """this program is free software you can redistribute it and or modify it under the terms of the gnu general public
        license as published by the free software foundation""",
    "cc-notice": """<<optional>>this work is<</optional>> licensed under <<optional>>a<</optional>> <<optional>>the<</optional>>
        creative commons attribution <<optional>>noncommercial<</optional>> <<optional>>sharealike<</optional>>
        <<optional>>noderivatives<</optional>> <<var: 2>> international <<optional>>public<</optional>> license""",
    "cc-by-nc": """<<optional>>licensed under<</optional>> cc by nc <<optional>>sa<</optional>> <<optional>>nd<</optional>> <<optional>>4 0<</optional>>""",
    "mpl-2.0": """this source code form is subject to the terms of the mozilla public license v 2 0""",
}

_WORD = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
#: Maps a byte to its lower case if it belongs to a word, else to a space.
_TO_WORDS = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in _WORD else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


@dataclass
class Automaton:
    """States are numbered; ``step[s]`` has the next state by word, ``wild[s]`` the next states by any word."""

    label: str
    step: list[dict[bytes, list[int]]] = field(default_factory=list)
    wild: list[list[int]] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)  # without a word
    start: int = 0
    end: int = 0
    anchor: bytes = b""  # the longest run of mandatory words; a text without it can't match
    before: int = 0  # at most so many words of a match stand before the anchor

    def state(self) -> int:
        self.step.append({})
        self.wild.append([])
        self.free.append([])
        return len(self.step) - 1

    def closure(self, states) -> set[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return seen

    def match(self, words: list[bytes], at: int) -> int:
        """The end of the longest match that begins at a word, or -1."""
        states, found, i = self.closure([self.start]), -1, at
        while states:
            if self.end in states:
                found = i
            if i == len(words):
                break
            states = self.closure([t for s in states for t in (*self.step[s].get(words[i], ()), *self.wild[s])])
            i += 1
        return found


def compile_template(label: str, template: str) -> Automaton:
    """The automaton of a template; raises ValueError for unclosed markup or a template without mandatory words."""
    a = Automaton(label)
    a.start = now = a.state()
    open_at: list[int] = []
    runs: list[list] = [[[], 0]]  # runs of mandatory words, each with the most words that may stand before it
    longest = 0
    for mark, n, word in re.findall(r"(<<optional>>|<</optional>>|<<var: *(\d+)>>)|(\S+?)(?=\s|<<|$)", template.lower()):
        if mark == "<<optional>>":
            open_at.append(now)
            now_next = a.state()
            a.free[now].append(now_next)
            now = now_next
            runs.append([[], 0])
        elif mark:
            if mark.startswith("<<var"):
                stop = a.state()
                a.free[now].append(stop)
                for _ in range(int(n)):
                    nxt = a.state()
                    a.wild[now].append(nxt)
                    a.free[nxt].append(stop)
                    now = nxt
                now = stop
                longest += int(n)
            else:
                if not open_at:
                    raise ValueError(f"{label}: an optional region is closed that is not open")
                stop = a.state()
                a.free[now].append(stop)
                a.free[open_at.pop()].append(stop)
                now = stop
            runs.append([[], 0])
        else:
            for w in words_of(word.encode()):
                nxt = a.state()
                a.step[now].setdefault(w, []).append(nxt)
                now = nxt
                if not open_at:
                    if not runs[-1][0]:
                        runs[-1][1] = longest
                    runs[-1][0].append(w)
                longest += 1
    if open_at or not any(r[0] for r in runs):
        raise ValueError(f"{label}: an optional region is left open, or no wording is mandatory")
    a.end = now
    best, a.before = max(runs, key=lambda r: len(r[0]))
    a.anchor = b" " + b" ".join(best) + b" "
    return a


def _places(line: bytes, phrase: bytes) -> list[int]:
    """Word numbers at which a phrase (with a space on both sides) stands in a line of words with single spaces."""
    out, at, word, counted = [], line.find(phrase), 0, 0
    while at >= 0:
        word += line.count(b" ", counted, at)
        counted = at
        out.append(word)
        at = line.find(phrase, at + 1)
    return out


class Scanner:
    """Phrases and templates, compiled once."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str]):
        self.phrases = [(b" " + b" ".join(words_of(p.encode())) + b" ", label) for p, label in phrases.items()]
        self.automata = [compile_template(label, t) for label, t in templates.items()]

    def scan(self, text: bytes):
        """(number of words, [(label, start)] of phrases, [(label, start, end)] of templates)."""
        words = words_of(text)
        line = b" " + b" ".join(words) + b" "
        base = [(label, at) for phrase, label in self.phrases if phrase in line for at in _places(line, phrase)]
        spans = []
        for a in self.automata:
            if a.anchor not in line:
                continue
            done = 0
            for place in _places(line, a.anchor):
                if place < done:
                    continue
                # the longest match around the anchor: from the first word a match can begin with
                for at in range(max(done, place - a.before), place + 1):
                    end = a.match(words, at)
                    if end > place:
                        spans.append((a.label, at, end))
                        done = end
                        break
        return len(words), base, spans


def _covered(spans) -> int:
    """The number of words in any of the (start, end) spans."""
    total, reach = 0, 0
    for a, b in sorted(spans):
        total += max(0, b - max(a, reach))
        reach = max(reach, b)
    return total


def _batches(it, scanner: Scanner):
    lengths = {label: p.count(b" ") - 1 for p, label in scanner.phrases}
    for batch in it:
        rows = []
        for value in batch["text"].cast(pa.binary()):
            n, base, spans = scanner.scan(value.as_py())
            starts = [at for _, at in base]
            labels = {label for label, _ in base}
            cover = _covered([(s, e) for _, s, e in spans] + [(at, at + lengths[label]) for label, at in base])
            rows.append((n, len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)),
                         ",".join(sorted(labels | {s[0] for s in spans})), cover / n if n else 0.0,
                         [{"label": a, "start": s, "end": e} for a, s, e in spans]))
        columns = list(zip(*rows)) if rows else [()] * 8
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), SPANS]
        yield pa.RecordBatch.from_arrays([batch["id"], *(pa.array(c, k) for c, k in zip(columns, kinds))],
                                         ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])


SPANS = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] | None = None,
                 templates: dict[str, str] | None = None) -> DataFrame:
    """License phrases and templates in every whole text.

    Result, one row per input row: id_col, n_words, n_base (places of phrases), first_word and last_word (smallest and
    largest start of a phrase, null without one), base_labels, labels (with those of the templates; distinct, sorted,
    comma-joined), score (share of words covered by phrases and template matches, 0 to 1) and spans (label, start,
    end of each template match, in words).

    Words are runs of digits, letters and non-ASCII bytes, with A-Z lower-cased. Places of phrases may overlap;
    matches of one template don't. A null text counts as empty: no words, empty labels, score 0. Null ids stay null,
    repeated rows stay repeated, other columns are not read, an empty table gives an empty result. The time for a text
    is in proportion to its length and to the number of places where a template's anchor wording stands.
    """
    scanner = Scanner(PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates)
    rows = pick(docs, id=id_col, text=text_col).withColumn("text", as_text(F.col("text")))
    kind = dict(rows.dtypes)["id"]
    out = rows.mapInArrow(lambda it: _batches(it, scanner), f"id {kind}, n_words long, n_base long, first_word long, last_word long, "
                          "base_labels string, labels string, score double, spans array<struct<label: string, start: bigint, end: bigint>>")
    return out.withColumnRenamed("id", id_col)


def op6_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).drop("spans")
