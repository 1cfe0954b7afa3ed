"""Chat formatting with typed content parts, in DataFrame functions only.

A turn's content is a list of parts: text, image, audio or document. A visitor flattens it into one string, in which
every part that is not text stands as a placeholder, and records for each placeholder the attachment's reference and
the number of tokens that it expands to. Turns are framed by control strings; control strings inside texts are escaped
reversibly, so that the frame can always be told from what people wrote.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm.common import table

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
OTHER = "<|attachment|>"
# Control strings of common chat formats, which texts must not contain either.
FOREIGN = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>",
           "<|eot_id|>", "<|start_header_id|>", "<|end_header_id|>", "<start_of_turn>", "<end_of_turn>")
CONTROL = (TURN, SAYS, END, *PLACEHOLDERS.values(), OTHER, *FOREIGN)
#: Starts an escape: itself and one more character, "0" for itself, a letter for a control string.
ESCAPE = "␛"
CODES = {c: chr(ord("a") + i) for i, c in enumerate(CONTROL)}

PARTS = "array<struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>>"


@dataclass(frozen=True)
class Expansion:
    """How many tokens an attachment stands for: an image one per started patch, audio per started 1 / rate second,
    a document per page. Sizes that are null or negative count as 0."""

    patch: int = 14
    audio_rate: float = 12.5
    page_tokens: int = 1024


def escape(text: Column) -> Column:
    """The text without control strings; ``unescape`` gives it back. What replaces them contains none of their
    characters in a row, so that no new control string can arise."""
    out = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "0"))
    for control, code in CODES.items():
        out = F.replace(out, F.lit(control), F.lit(ESCAPE + code))
    return out


def unescape(text: Column) -> Column:
    for control, code in CODES.items():
        text = F.replace(text, F.lit(ESCAPE + code), F.lit(control))
    return F.replace(text, F.lit(ESCAPE + "0"), F.lit(ESCAPE))


def _tokens(part: Column, e: Expansion) -> Column:
    size = lambda name: F.greatest(F.coalesce(part[name], F.lit(0)), F.lit(0))
    image = F.ceil(size("width") / e.patch) * F.ceil(size("height") / e.patch)
    return (F.when(part["type"] == "image", image).when(part["type"] == "audio", F.ceil(size("seconds") * e.audio_rate))
            .when(part["type"] == "document", size("pages") * e.page_tokens).otherwise(F.lit(0))).cast("long")


def _placeholder(kind: Column) -> Column:
    out = F.when(kind == "image", PLACEHOLDERS["image"])
    for k in ("audio", "document"):
        out = out.when(kind == k, PLACEHOLDERS[k])
    return out.otherwise(OTHER)


def flatten(parts: Column, e: Expansion = Expansion()) -> tuple[Column, Column]:
    """(content, attachments) of a list of parts. Each part is visited in order: text is escaped, any other part
    leaves a placeholder and an attachment (type, ref, tokens). A part of an unknown type is an attachment of no
    tokens; a null part or a part without a type is a text part; null texts are empty."""
    parts = F.coalesce(parts, F.from_json(F.lit("[]"), PARTS))
    is_text = lambda p: F.coalesce(p["type"] == "text", F.lit(True))
    content = F.array_join(F.transform(parts, lambda p: F.when(is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(_placeholder(p["type"]))), "")
    attachments = F.transform(F.filter(parts, lambda p: ~is_text(p)), lambda p: F.struct(
        p["type"].alias("type"), p["ref"].alias("ref"), _tokens(p, e).alias("tokens")))
    return content, attachments


def text_part(text: Column) -> Column:
    """A content list of one text part."""
    null = lambda kind: F.lit(None).cast(kind)
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), null("string").alias("ref"), null("int").alias("width"),
                            null("int").alias("height"), null("double").alias("seconds"), null("int").alias("pages")))


def format_chat(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str | None = "text", parts_col: str | None = None, trained_role: str = "assistant",
                expansion: Expansion = Expansion()) -> DataFrame:
    """One row per conversation: conv_col, formatted, loss_mask, attachments, expanded_tokens.

    Turns come from ``parts_col`` (of type PARTS) or, without it, are one text part of ``text_col`` each. They stand
    in ascending order of ``turn_col``, ties by role and content, so that repeated rows are repeated turns. A turn reads
    TURN role SAYS content END. ``loss_mask`` has (turn, start, length) for each turn of ``trained_role``: the number of
    the turn from 0, and where its content stands in the turn's string, TURN left out, from 0 in code points.
    ``attachments`` has (turn, position, type, ref, tokens): position counts the attachments of a turn from 0.
    ``expanded_tokens`` is what all placeholders expand to.

    Null turns come first, null roles and texts are empty, null content lists have no parts; rows with a null
    conversation form one of their own. Other columns are not read; an empty table gives an empty result. A
    conversation is one string of the result, so that it has to fit into a row, and into memory, as such.
    """
    parts = turns[parts_col] if parts_col else text_part(turns[text_col].cast("string"))
    content, attachments = flatten(parts, expansion)
    rows = turns.select(turns[conv_col].alias("conv"), F.struct(
        turns[turn_col].alias("turn"), F.coalesce(turns[role_col].cast("string"), F.lit("")).alias("role"),
        content.alias("content"), attachments.alias("attachments")).alias("t"))
    own = rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    head = lambda t: F.concat(escape(t["role"]), F.lit(SAYS))
    formatted = F.array_join(F.transform("ts", lambda t: F.concat(F.lit(TURN), head(t), t["content"], F.lit(END))), "")
    mask = F.filter(F.transform("ts", lambda t, i: F.when(t["role"] == trained_role, F.struct(
        i.alias("turn"), F.char_length(head(t)).alias("start"), F.char_length(t["content"]).alias("length")))), lambda x: x.isNotNull())
    listed = F.flatten(F.transform("ts", lambda t, i: F.transform(t["attachments"], lambda a, k: F.struct(
        i.alias("turn"), k.alias("position"), a["type"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    out = own.select(F.col("conv").alias(conv_col), formatted.alias("formatted"), mask.alias("loss_mask"), listed.alias("attachments"))
    return out.withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda s, a: s + a["tokens"]))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of (role, content, piece), content still escaped."""
    pieces = F.filter(F.split(formatted, r"<\|turn\|>"), lambda p: p != "")
    says = r"<\|says\|>"
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.split(p, says)[0]).alias("role"),
        F.regexp_replace(F.split(p, says)[1], r"<\|end\|>$", "").alias("content"), p.alias("piece")))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, formatted; digests read back from the formatted text and its mask."""
    both = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").cast("int").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(both).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("int").alias("turn"), "role", "text").union(extra)
    chats = format_chat(rows).select("conv_id", "formatted", "loss_mask", read_turns(F.col("formatted")).alias("turns"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), unescape(t["content"]), F.lit("\n"))), "")
    loss = F.array_join(F.transform("loss_mask", lambda m: unescape(F.substring(
        F.get("turns", m["turn"])["piece"], m["start"] + 1, m["length"]))), "")
    digests = chats.select("conv_id", F.size("turns").cast("long").alias("n_turns"), told.alias("told"), loss.alias("loss"),
                           F.char_length("formatted").cast("long").alias("formatted_chars"))
    return digests.select("conv_id", "n_turns", F.sha2(F.encode("told", "UTF-8"), 256).alias("turns_sha256"),
                          F.char_length("loss").cast("long").alias("loss_chars"),
                          F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"), "formatted_chars")


def _sql_escaped(column: str) -> str:
    out = f"replace({column}, '{ESCAPE}', '{ESCAPE}0')"
    for control, code in CODES.items():
        out = f"replace({out}, '{control}', '{ESCAPE}{code}')"
    return out


ORACLE = f"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len(TURN + SAYS + END)} + length({_sql_escaped('role')}) + length({_sql_escaped('text')})) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id"""
