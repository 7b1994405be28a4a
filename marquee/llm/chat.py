"""Chat formatting with Spark expressions only (operator 4).

Method.  A conversation's turns are collected as structs and sorted; neighbours with the same role are merged into one
block with array functions (block starts, then slices), and everything is concatenated.  The template of a block is

    <s>[ROLE]role[/ROLE]text[TURN]text ...</s>

The control strings ``<s> </s> [ROLE] [/ROLE] [TURN] [INST] [/INST]`` inside roles and texts get one backslash after
their first character, and so do strings that already have backslashes there; taking one away restores them exactly.
The loss mask is a list of (start, length) spans in code points of the formatted text: the assistants' texts, without
the marks between them.

Defined results: null text and null role are empty; a null turn sorts first; rows with the same turn sort by role and
text; repeated rows stay; rows with null conv_id form one conversation.  A conversation is one row of the result, so
its size bounds what one group holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REST = r"(?:/?s>|/?(?:ROLE|INST)\]|TURN\])"
LEARNED = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(?=\\*{REST})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(?=\\*{REST})", "$1")


def format_conversations(turns: DataFrame) -> DataFrame:
    """``turns(conv_id, turn, role, text)`` to ``conv_id, formatted, loss_spans``, one row per conversation."""
    empty = F.lit("")
    row = F.struct(F.col("turn").cast("long").alias("turn"),
                   F.coalesce(F.col("role").cast("string"), empty).alias("role"),
                   F.coalesce(F.col("text").cast("string"), empty).alias("text"))
    out = turns.select(F.col("conv_id").cast("long"), row.alias("row")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("row")).alias("rows"))
    # First place of each run of one role, and the place after the last.
    out = out.withColumn("starts", F.filter(
        F.sequence(F.lit(0), F.size("rows") - 1),
        lambda i: (i == 0) | (F.col("rows")[i]["role"] != F.col("rows")[F.greatest(i - 1, F.lit(0))]["role"])))
    out = out.withColumn("ends", F.concat(F.slice("starts", 2, F.size("starts")), F.array(F.size("rows"))))
    out = out.withColumn("blocks", F.transform("starts", lambda s, k: F.struct(
        F.col("rows")[s]["role"].alias("role"),
        F.transform(F.slice("rows", s + 1, F.col("ends")[k] - s), lambda x: escape(x["text"])).alias("texts"))))
    out = out.withColumn("parts", F.transform("blocks", lambda b: F.concat(
        F.lit("<s>[ROLE]"), escape(b["role"]), F.lit("[/ROLE]"), F.array_join(b["texts"], "[TURN]"), F.lit("</s>"))))
    # Spans: running length of the blocks before, then of the texts before within the block.
    begin = F.aggregate(
        "parts", F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("list")),
        lambda acc, p: F.struct((acc["at"] + F.length(p)).alias("at"),
                                F.concat(acc["list"], F.lit(","), acc["at"].cast("string")).alias("list")))["list"]
    out = out.withColumn("begins", F.transform(F.slice(F.split(begin, ","), 2, F.size("parts")),
                                               lambda x: x.cast("long")))
    spans = F.flatten(F.transform("blocks", lambda b, k: F.when(b["role"] == LEARNED, F.transform(
        F.sequence(F.lit(1), F.size(b["texts"])),
        lambda j: F.struct(
            (F.col("begins")[k] + F.length(F.lit("<s>[ROLE][/ROLE]")) + F.length(escape(b["role"]))
             + F.length(F.array_join(F.slice(b["texts"], F.lit(1), j - 1), "[TURN]"))
             + F.when(j > 1, F.length(F.lit("[TURN]"))).otherwise(0)).cast("long").alias("start"),
            F.length(b["texts"][j - 1]).cast("long").alias("length")))).otherwise(
        F.array().cast("array<struct<start:bigint,length:bigint>>"))))
    return out.select("conv_id", F.array_join("parts", "").alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss text out of ``formatted`` and ``loss_spans``: adds ``turns`` (role, text) and ``loss_text``."""
    blocks = F.filter(F.split("formatted", "</s>"), lambda b: b != "")
    out = formatted.withColumn("_blocks", blocks)
    turns = F.flatten(F.transform("_blocks", lambda b: F.transform(
        F.split(F.regexp_replace(b, r"^(?s).*?\[/ROLE\]", ""), r"\[TURN\]"),
        lambda t: F.struct(unescape(F.regexp_extract(b, r"^(?s)<s>\[ROLE\](.*?)\[/ROLE\]", 1)).alias("role"),
                           unescape(t).alias("text")))))
    out = out.withColumn("turns", turns)
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(
        F.substring("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
    return out.withColumn("loss_text", loss).drop("_blocks")
