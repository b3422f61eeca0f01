"""Chat formatting with Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Control strings of the template, and what an escaped text can't hold: these
#: and the markers of two other common templates. Fixed values.
START, BODY, NEXT, END = "<|start|>", "<|body|>", "<|next|>", "<|end|>"
CONTROL = r"(<)(\||/?s>|</?SYS>>)|(\[)(/?INST\])"
ESCAPED = r"(<)\\(\||/?s>|</?SYS>>)|(\[)\\(/?INST\])"


def escape(text: Column) -> Column:
    """``text`` without control strings; :func:`unescape` gives it back exactly.

    A backslash is doubled first, then one goes behind the first character of
    each control string. A single backslash there can come from nothing else.
    """
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, "$1$3\\\\$2$4")


def unescape(text: Column) -> Column:
    """The inverse of :func:`escape`."""
    return F.replace(F.regexp_replace(text, ESCAPED, "$1$3$2$4"), F.lit("\\\\"), F.lit("\\"))


def format_chat(conversations: DataFrame, *, train_on: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans.

    Turn structs are collected and sorted by (turn, role, text). Adjacent turns
    of one role share a block, ``<|start|>role<|body|>text<|next|>text<|end|>``.
    loss_spans are [start, length) in code points of ``formatted``, one for each
    turn whose role is in ``train_on``. Null texts and roles count as empty,
    null turns come first, rows with a null conv_id form one conversation; an
    empty table gives no rows. A conversation is one value of the result, so it
    has to fit in a task, as any row has. Columns other than conv_id, turn, role
    and text are ignored.
    """
    clean = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    turns = clean.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    # an empty turn goes before the first, so that every turn has one before it
    shifted = turns.withColumn("_all", F.col("turns")).withColumn(
        "turns", F.concat(F.array(F.lit(None).cast("struct<turn:bigint,role:string,text:string>")), F.col("turns"))
    )

    def piece(t: Column, i: Column) -> Column:
        """What stands before a turn's text, the text, and what closes it."""
        before, after = F.try_element_at(F.col("turns"), i + 1), F.try_element_at(F.col("turns"), i + 3)
        joins = (i > 0) & before["role"].eqNullSafe(t["role"])
        last = ~F.coalesce(after["role"].eqNullSafe(t["role"]), F.lit(False))
        return F.struct(
            F.when(joins, F.lit(NEXT)).otherwise(F.concat(F.lit(START), escape(t["role"]), F.lit(BODY))).alias("head"),
            escape(t["text"]).alias("body"),
            F.when(last, F.lit(END)).otherwise(F.lit("")).alias("tail"),
            t["role"].isin(*train_on).alias("train"),
        )

    pieces = shifted.select("conv_id", F.transform("_all", piece).alias("pieces"))
    size = lambda p: F.length(p["head"]) + F.length(p["body"]) + F.length(p["tail"])
    spans = F.aggregate(
        F.col("pieces"),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda s, p: F.struct(
            (s["at"] + size(p)).alias("at"),
            F.when(
                p["train"],
                F.concat(
                    s["spans"],
                    F.array(F.struct((s["at"] + F.length(p["head"])).alias("start"), F.length(p["body"]).alias("length"))),
                ),
            ).otherwise(s["spans"]).alias("spans"),
        ),
        lambda s: s["spans"],
    )
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], p["tail"])), "")
    return pieces.select("conv_id", text.alias("formatted"), spans.alias("loss_spans"))


def read_chat(formatted: DataFrame) -> DataFrame:
    """What :func:`format_chat` wrote, read back from ``formatted`` and ``loss_spans``.

    Returns conv_id, turns (role and text of each), loss_text, formatted_chars.
    """
    blocks = F.filter(F.split("formatted", F.lit(r"<\|end\|>")), lambda b: b != "")

    def turns(b: Column) -> Column:
        parts = F.split(F.substring(b, len(START) + 1, 2**31 - 1), F.lit(r"<\|body\|>"))
        return F.transform(
            F.split(parts[1], F.lit(r"<\|next\|>")),
            lambda t: F.struct(unescape(parts[0]).alias("role"), unescape(t).alias("text")),
        )

    loss = F.array_join(
        F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), ""
    )
    return formatted.select(
        "conv_id", F.flatten(F.transform(blocks, turns)).alias("turns"), loss.alias("loss_text"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def chat_digest(read: DataFrame) -> DataFrame:
    """Counts and digests of what :func:`read_chat` returns."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )
