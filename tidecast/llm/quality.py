"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Each rule bounds a ratio of two measures of the text in whole percent, so that no rounding is involved. The compiled
projection needs no shuffle and no user function; the texts don't leave the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import SPACES, as_text, table


@dataclass(frozen=True)
class Rule:
    """100 * over must lie within [at_least, at_most] * under, in texts of ``from_words`` words or more."""

    name: str
    over: str
    under: str
    at_least: int | None = None
    at_most: int | None = None
    from_words: int = 0


#: Measures: n_words, word_chars, n_symbols, n_bangs, n_stop, n_lines, n_dup_lines, n_bullets,
#: n_ellipses, n_repeat_words; ``one`` is 1.
RULES = (
    Rule("long enough", "n_words", "one", at_least=1000),
    Rule("few repeated words", "n_repeat_words", "n_words", at_most=20),
    Rule("word length", "word_chars", "n_words", at_least=200, at_most=2000),
    Rule("few symbols", "n_symbols", "n_words", at_most=30),
    Rule("few exclamation marks", "n_bangs", "n_words", at_most=50),
    Rule("some stop words", "n_stop", "n_words", at_least=1, from_words=100),
    Rule("few repeated lines", "n_dup_lines", "n_lines", at_most=50),
    Rule("few bulleted lines", "n_bullets", "n_lines", at_most=90, from_words=50),
    Rule("few broken lines", "n_ellipses", "n_lines", at_most=50, from_words=50),
)
#: The rules that make up base_failed of the contract.
BASE = ("long enough", "few repeated words")

# Frequent words of four languages.
STOP_WORDS = (
    "the of and to a in is that it for was on with as be by this are at from have or an not "
    "de la le et les des en un du que une pour est qui dans par sur pas au avec "
    "der die und den von zu das mit sich auf für im ist dem nicht ein eine als "
    "el y los las se del por con no su para es al lo").split()

#: The languages of STOP_WORDS, and the rule that holds for texts of these only.
LANGS, LANG_RULE = ("en", "fr", "de", "es"), "some stop words"

SYMBOLS = "#*$%&|<>"


def let(value: Column, body) -> Column:
    """``body(value)``, with the value computed once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _without(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def _repeated(words: Column) -> Column:
    """The number of words in five-word windows found twice or more. Hashes only show that nothing repeats; what
    repeats is counted by the windows themselves."""
    starts = F.sequence(F.lit(0), F.size(words) - 5)
    five = lambda i: [F.get(words, i + k) for k in range(5)]

    def places(g):
        same = lambda x, j: F.coalesce(x["s"] == F.get(g, j)["s"], F.lit(False))
        found = F.transform(F.filter(F.transform(g, lambda x, j: F.struct(x["i"].alias("i"), (same(x, j - 1) | same(x, j + 1)).alias("r"))),
                                     lambda x: x["r"]), lambda x: x["i"])
        return let(F.array_sort(found), lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(5), F.coalesce(F.get(p, k + 1) - x, F.lit(5)))), F.lit(0), lambda a, x: a + x))

    def by_windows():
        return let(F.sort_array(F.transform(starts, lambda i: F.struct(F.concat_ws(" ", *five(i)).alias("s"), i.alias("i")))), places)

    return F.when(F.size(words) < 6, F.lit(0)).otherwise(let(
        F.transform(starts, lambda i: F.xxhash64(*five(i))),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(by_windows())))


def measures(text: Column, stop_words=STOP_WORDS) -> Column:
    """A struct of a text's measures, all long; a null text counts as empty."""
    text = as_text(text)
    number = lambda col, name: col.cast("long").alias(name)

    def of(w, lines):
        return F.struct(
            F.lit(1).cast("long").alias("one"),
            number(F.size(w), "n_words"),
            number(F.char_length(F.translate(text, " \t\n\x0b\x0c\r", "")), "word_chars"),
            number(_without(text, SYMBOLS), "n_symbols"),
            number(F.char_length(text) - F.char_length(F.replace(text, F.lit("!"), F.lit(""))), "n_bangs"),
            number(F.size(F.filter(w, lambda x: F.lower(x).isin(*stop_words))), "n_stop"),
            number(F.size(lines), "n_lines"),
            number(F.size(lines) - F.size(F.array_distinct(lines)), "n_dup_lines"),
            number(F.size(F.filter(lines, lambda x: x.startswith("- ") | x.startswith("* ") | x.startswith("• "))), "n_bullets"),
            number(F.size(F.filter(lines, lambda x: x.endswith("...") | x.endswith("…"))), "n_ellipses"),
            number(_repeated(w), "n_repeat_words"))

    words = F.filter(F.split(text, f"[{SPACES}]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACES}]"))
    return let(words, lambda w: let(lines, lambda x: of(w, x)))


def broken(rule: Rule, m: Column) -> Column:
    """Whether the measures break the rule."""
    over, under = 100 * m[rule.over], m[rule.under]
    tests = [over < rule.at_least * under] * (rule.at_least is not None) + [over > rule.at_most * under] * (rule.at_most is not None)
    bad = tests[0] if len(tests) == 1 else tests[0] | tests[1]
    return bad & (m["n_words"] >= rule.from_words) if rule.from_words else bad


def verdict(m: Column, rules=RULES) -> Column:
    """Names of the rules that the measures break; empty for a text to keep."""
    return F.array_compact(F.array(*[F.when(broken(r, m), F.lit(r.name)) for r in rules]))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES, stop_words=STOP_WORDS) -> DataFrame:
    """Measures of every whole text and the rules it breaks: id_col, the measures, broken (array of names), kept.

    A null or empty text has zero words and breaks the rule on length. Null ids stay null, rows repeat as they do in
    the input, other columns are not read (their names may clash), an empty table gives an empty result. A very long
    text is measured whole; the memory it takes is in proportion to it.
    """
    m = docs.select(docs[id_col].alias("id"), measures(docs[text_col], stop_words).alias("m"))
    names = [f.name for f in m.schema["m"].dataType.fields if f.name != "one"]
    judged = m.select("id", "m", verdict(F.col("m"), rules).alias("broken"))
    return judged.select(F.col("id").alias(id_col), *[F.col("m")[n].alias(n) for n in names], "broken", (F.size("broken") == 0).alias("kept"))


def keep_clean(docs: DataFrame, text_col: str = "text", rules=RULES, lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose text breaks no rule, with all their columns. The rule on stop words asks only texts
    in one of LANGS (``en-GB`` counts as ``en``); without a column ``lang_col`` it asks all."""
    if lang_col not in docs.columns:
        return docs.filter(let(measures(docs[text_col]), lambda m: F.size(verdict(m, rules)) == 0))
    lang = F.lower(F.substring_index(docs[lang_col].cast("string"), "-", 1))
    covered = F.coalesce(lang.isin(*LANGS), F.lit(False))
    waived = F.when(covered, F.array().cast("array<string>")).otherwise(F.array(F.lit(LANG_RULE)))
    return docs.filter(let(measures(docs[text_col]), lambda m: F.size(F.array_except(verdict(m, rules), waived)) == 0))


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    q = quality(table(spark, sf_dir, "documents"))
    base = F.exists("broken", lambda x: x.isin(*BASE))
    return q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept")


def _sql_rule(r: Rule) -> str:
    tests = [f"100 * {r.over} < {r.at_least} * {r.under}"] * (r.at_least is not None) + [f"100 * {r.over} > {r.at_most} * {r.under}"] * (r.at_most is not None)
    return f"(({' OR '.join(tests)}) AND n_words >= {r.from_words})"


ORACLE = r"""
WITH t AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, r, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
windows AS (
  SELECT r, i, list_slice(w, i, i + 4) AS s FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM windows) WHERE n > 1),
repeats AS (
  SELECT r, sum(least(5, coalesce(next - i, 5))) AS n_repeat_words
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS next FROM twice) GROUP BY r),
m AS (
  SELECT doc_id, 1 AS one, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    length(text) - length(replace(text, '!', '')) AS n_bangs,
    len(list_filter(w, lambda x: lower(x) IN (STOP_LIST))) AS n_stop,
    len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    len(list_filter(lines, lambda x: starts_with(x, '- ') OR starts_with(x, '* ') OR starts_with(x, '• '))) AS n_bullets,
    len(list_filter(lines, lambda x: ends_with(x, '...') OR ends_with(x, '…'))) AS n_ellipses,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN repeats USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, BASE_RULES AS base_failed, NOT (ALL_RULES) AS kept FROM m
""".replace("STOP_LIST", ", ".join(f"'{w}'" for w in STOP_WORDS)).replace(
    "BASE_RULES", "(" + " OR ".join(_sql_rule(r) for r in RULES if r.name in BASE) + ")").replace(
    "ALL_RULES", " OR ".join(_sql_rule(r) for r in RULES))
