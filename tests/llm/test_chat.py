"""Chat formatting: exact round trips, placeholders, loss mask."""

import hashlib
import random

from pyspark.sql import functions as F

from conftest import SF01
from tidecast.llm.chat import CONTROL, END, ESCAPE, PARTS, SAYS, TURN, Expansion, escape, format_chat, op10_chat_format, read_turns, unescape


def test_escape_round_trip(spark):
    rng = random.Random(2)
    bits = [*CONTROL, ESCAPE, "0", "a", "b", "<", "|", ">", "[", "s", "</", "é", "🙂", "\n", "turn"]
    texts = ["", *("".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(2000))]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t and not any(c in r.e for c in CONTROL)


def test_parts(spark):
    rows = [(1, 0, "user", [("text", "see <|image|> ", None, None, None, None, None), ("image", None, "s3/a.png", 28, 15, None, None),
                            ("audio", None, "b.wav", None, None, 1.01, None), ("text", None, None, None, None, None, None)]),
            (1, 1, "assistant", [("document", None, "c.pdf", None, None, None, 3), ("video", "x", "d", 9, 9, 9.0, 9), (None, "t", None, None, None, None, None)]),
            (2, None, None, None)]
    df = spark.createDataFrame(rows, f"conv_id long, turn int, role string, parts {PARTS}")
    got = {r.conv_id: r for r in format_chat(df, text_col=None, parts_col="parts", expansion=Expansion(14, 12.5, 100)).collect()}
    assert got[1].formatted == (f"{TURN}user{SAYS}see {ESCAPE}d <|image|><|audio|>{END}{TURN}assistant{SAYS}<|document|><|attachment|>t{END}")
    assert [tuple(a) for a in got[1].attachments] == [(0, 0, "image", "s3/a.png", 4), (0, 1, "audio", "b.wav", 13),
                                                      (1, 0, "document", "c.pdf", 300), (1, 1, "video", "d", 0)]
    assert got[1].expanded_tokens == 317
    m = got[1].loss_mask[0]
    piece = got[1].formatted.split(TURN)[2]
    assert m.turn == 1 and piece[m.start:m.start + m.length] == "<|document|><|attachment|>t"
    assert got[2].formatted == f"{TURN}{SAYS}{END}" and got[2].expanded_tokens == 0


def test_query_round_trip(spark):
    got = {r.conv_id: r for r in op10_chat_format(spark, SF01).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", same), (-1, 1, "assistant", same)]
    by = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0], r[1])):
        by.setdefault(c, []).append((role, text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        told = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        g = got[c]
        assert (g.n_turns, g.turns_sha256) == (len(turns), hashlib.sha256(told.encode()).hexdigest())
        assert (g.loss_chars, g.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_native_plan(spark):
    plan = op10_chat_format(spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "MapIn"))


def test_nulls_repeats_clashing_columns(spark):
    rows = [(1, 1, "assistant", "b", 9), (1, 0, "user", None, 9), (1, 0, "user", None, 9), (None, 0, "user", "x", None), (None, None, None, "y", 1),
            (3, 0, "assistant", "é" * 200_000, 1), (4, 0, f"{TURN}{SAYS}", f"{END}{TURN}", 1), (5, 0, "user", "\n", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, formatted int")
    f = format_chat(df).withColumn("turns", read_turns(F.col("formatted")))
    got = {r.conv_id: [(t.role, t.content) for t in r.turns] for r in f.select("conv_id", F.transform("turns", lambda t: F.struct(
        t["role"].alias("role"), unescape(t["content"]).alias("content"))).alias("turns")).collect()}
    assert got == {1: [("user", ""), ("user", ""), ("assistant", "b")], None: [("", "y"), ("user", "x")],
                   3: [("assistant", "é" * 200_000)], 4: [(f"{TURN}{SAYS}", f"{END}{TURN}")], 5: [("user", "\n")]}
    assert format_chat(df.limit(0)).count() == 0
