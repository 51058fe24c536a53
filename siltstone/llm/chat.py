"""Chat formatting over typed content parts, with DataFrame functions only.

A visitor (one column expression for each part type) flattens the parts of a turn: text is escaped and kept, an image,
audio or document part becomes a placeholder in its place, its reference is recorded, and the tokens it expands to are
counted. Turns are marked by control strings; inside texts those are escaped, so the output can be read back exactly.

Escaping: backslash becomes two; the first character of a control string, `<` or `[`, becomes `\\l` or `\\b`.

Defined results: null text or role: empty; null parts: no parts; turns are ordered by turn (null first), then role,
text; repeated rows are turns of their own; rows of the null conversation form one conversation; very long texts stay
whole, a conversation is one row; an empty table gives no conversations; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import pick, table

OPEN, SEP, CLOSE = "<|turn|>", "<|text|>", "<|end|>"
#: What a text must not hold unescaped: the template's own marks and those of common chat templates.
ANGLED = r"<(?=\||/?s>|<?/?SYS>)"
SQUARE = r"\[(?=/?(?:INST|TOOL_CALLS|AVAILABLE_TOOLS|TOOL_RESULTS)\])"
#: Tokens that one unit of a part expands to: image tiles, audio seconds, document pages; a part without units has one.
TOKENS_A_UNIT = {"image": 256, "audio": 25, "document": 512}
PART = "array<struct<type:string,text:string,ref:string,units:long>>"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(F.regexp_replace(doubled, ANGLED, r"\\l"), SQUARE, r"\\b")


def unescape(text: Column) -> Column:
    """Pairs of backslashes are told apart first, from the left; what is left of each piece holds marks only."""
    pieces = F.split(text, r"\\\\", -1)
    return F.array_join(F.transform(pieces, lambda p: F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("["))), "\\")


def _placeholder(kind: str) -> Callable[[Column], Column]:
    return lambda part: F.lit(f"<|{kind}|>")


#: The visitor: how each type of part is written.
VISITOR: dict[str, Callable[[Column], Column]] = {
    "text": lambda part: escape(F.coalesce(part["text"], F.lit(""))),
    "image": _placeholder("image"),
    "audio": _placeholder("audio"),
    "document": _placeholder("document"),
}


def visit(part: Column) -> Column:
    """A part as written; parts of unknown type are written as text."""
    out = VISITOR["text"](part)
    for kind, how in VISITOR.items():
        if kind != "text":
            out = F.when(part["type"] == kind, how(part)).otherwise(out)
    return out


def part_tokens(part: Column) -> Column:
    out = F.lit(0).cast("long")
    for kind, each in TOKENS_A_UNIT.items():
        out = F.when(part["type"] == kind, F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(1)) * each).otherwise(out)
    return out


def text_parts(text: Column) -> Column:
    """One text part of a plain text."""
    part = F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("units"))
    return F.array(part).cast(PART)


def format_conversations(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """turns (conv_id, turn, role, parts) to one row a conversation.

    formatted: the text; mask: [start, end) ranges of code points under the loss; attachments: references in order,
    with the number of tokens each expands to; attachment_tokens: their sum.
    """
    rows = turns.select(
        "conv_id",
        F.struct(
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("parts", F.array().cast(PART)).alias("parts"),
        ).alias("t"),
    )
    # Written before grouping, so that the sort compares short fields first and each text is escaped once.
    body = F.array_join(F.transform("t.parts", visit), "")
    extra = F.transform(
        F.filter("t.parts", lambda p: p["type"].isin(*TOKENS_A_UNIT)),
        lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), part_tokens(p).alias("tokens")),
    )
    head = F.concat(F.lit(OPEN), escape(F.col("t.role")), F.lit(SEP))
    # Ties of turn and role go by what was said, not by how it is escaped.
    said = F.array_join(F.transform("t.parts", lambda p: F.coalesce(p["text"], F.lit(""))), "")
    written = rows.select("conv_id", F.struct(F.col("t.turn").alias("turn"), F.col("t.role").alias("role"), said.alias("said"), body.alias("body"), head.alias("head"), extra.alias("extra")).alias("w"))
    grouped = written.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("ws"))
    piece = lambda w: F.concat(w["head"], w["body"], F.lit(CLOSE))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("mask"))

    def step(acc: Column, w: Column) -> Column:
        begin = acc["at"] + F.length(w["head"])
        stop = begin + F.length(w["body"])
        mask = F.when(w["role"] == loss_role, F.concat(acc["mask"], F.array(F.struct(begin.alias("start"), stop.alias("end"))))).otherwise(acc["mask"])
        return F.struct((stop + len(CLOSE)).cast("long").alias("at"), mask.alias("mask"))

    return grouped.select(
        "conv_id",
        F.array_join(F.transform("ws", piece), "").alias("formatted"),
        F.aggregate("ws", start, step, lambda acc: acc["mask"]).alias("mask"),
        F.flatten(F.transform("ws", lambda w: w["extra"])).alias("attachments"),
    ).withColumn("attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda acc, a: acc + a["tokens"]))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation; placeholders stay in the text as written."""
    return F.transform(_pieces(formatted), lambda w: F.struct(unescape(w["role"]).alias("role"), unescape(w["body"]).alias("text")))


def _pieces(formatted: Column) -> Column:
    """array<struct<role, body>> as written, still escaped."""
    whole = F.split(formatted, r"<\|turn\|>", -1)
    turns = F.slice(whole, 2, F.greatest(F.size(whole) - 1, F.lit(0)))

    def one(piece: Column) -> Column:
        cut = F.split(piece, r"<\|text\|>", 2)
        body = F.element_at(cut, 2)
        return F.struct(F.element_at(cut, 1).alias("role"), F.substring(body, F.lit(1), F.length(body) - len(CLOSE)).alias("body"))

    return F.transform(turns, one)


def read_parts(formatted: Column) -> Column:
    """array<struct<role, parts: array<struct<type, text>>>>: a placeholder is a part of its type, with a null text.

    Texts that say the same are escaped, so they are read as text. Neighbouring texts of a turn are one part.
    """
    kinds = "|".join(TOKENS_A_UNIT)
    cut = "|".join([rf"(?=<\|(?:{kinds})\|>)", *[rf"(?<=<\|{k}\|>)" for k in TOKENS_A_UNIT]])

    def part(piece: Column) -> Column:
        kind = F.regexp_extract(piece, rf"^<\|({kinds})\|>$", 1)
        return F.struct(F.when(kind != "", kind).otherwise("text").alias("type"), F.when(kind == "", unescape(piece)).alias("text"))

    def parts(body: Column) -> Column:
        return F.transform(F.filter(F.split(body, cut, -1), lambda x: x != ""), part)

    return F.transform(_pieces(formatted), lambda w: F.struct(unescape(w["role"]).alias("role"), parts(w["body"]).alias("parts")))


def read_loss(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped."""
    return F.array_join(F.transform(mask, lambda m: unescape(F.substring(formatted, (m["start"] + 1).cast("int"), (m["end"] - m["start"]).cast("int")))), "")


def conversations_with_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = pick(table(spark, sf_dir, "conversations"), {"conv_id": "long", "turn": "long", "role": "string", "text": "string"})
    said = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text")
    )
    return talk.unionByName(probe)


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversations_with_probe(spark, sf_dir).withColumn("parts", text_parts(F.col("text")))
    out = format_conversations(turns.select("conv_id", "turn", "role", "parts"))
    back = out.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("mask")).alias("loss"))
    digest = F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256)
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        digest.alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
WITH talk AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(role) + length(text) + 23
    + length(text) - length(replace(text, '\', ''))
    + len(regexp_extract_all(text, '<</?SYS>')) + len(regexp_extract_all(text, '<\||</?s>|</?SYS>|\[/?(INST|TOOL_CALLS|AVAILABLE_TOOLS|TOOL_RESULTS)\]')) AS chars
  FROM talk
), by_conv AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
    sum(chars) AS chars
  FROM sized GROUP BY conv_id
)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM by_conv
"""

QUERIES = {"op10_chat": op10_chat}
ORACLES = {"op10_chat": ORACLE}
