"""Chat formatting as relational expressions.

The turns of a conversation are collected as structs and sorted; neighbouring turns of one
role become one block; blocks are concatenated:

    <turn user>text</turn>            one block, each followed by a line feed
    <turn assistant>text<next>text</turn>      two assistant turns in a row

Every control string begins with ``<``. Inside texts and roles the backslash is written
``\\b``, ``<`` is ``\\l`` and ``>`` (roles only) is ``\\g``, so texts cannot forge a mark and
the way back is exact. The loss mask is a run-length list over the formatted code points:
(skip, take) for every mark; what is taken are the assistant's texts, without any mark.

A conversation is one row of the result, so one row must hold it; all steps are linear in
its length. Null texts and roles count as empty. Turns with equal numbers are ordered by
role and text, null turn numbers come first, null conversation ids are one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import quoted

LEARNED = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    plain = F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">"))
    return F.replace(plain, F.lit("\\b"), F.lit("\\"))


def format_chats(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, formatted, loss_runs array<struct<skip, take>>), a row for each conversation."""
    said = F.struct(
        F.col(quoted(turn)).alias("turn"),
        F.coalesce(F.col(quoted(role)).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(quoted(text)).cast("string"), F.lit("")).alias("text"),
    )
    # sorted as given: escaping would change the order of equal turn numbers
    sorted_ = turns.groupBy(F.col(quoted(conv)).alias("conv")).agg(F.sort_array(F.collect_list(said)).alias("said"))
    ordered = sorted_.select(
        "conv",
        F.transform(
            "said",
            lambda x: F.struct(F.replace(escape(x["role"]), F.lit(">"), F.lit("\\g")).alias("role"), escape(x["text"]).alias("text")),
        ).alias("turns"),
    )
    # where a block begins: another role than the turn before
    begins = F.filter(
        F.transform("turns", lambda x, i: F.when((i == 0) | (x["role"] != F.get("turns", i - 1)["role"]), i)), lambda i: i.isNotNull()
    )
    blocks = F.transform(
        "begins",
        lambda i, k: F.struct(
            F.get("turns", i)["role"].alias("role"),
            F.transform(
                F.slice("turns", i + 1, F.coalesce(F.get("begins", k + 1), F.size("turns")) - i), lambda x: x["text"]
            ).alias("texts"),
        ),
    )
    merged = ordered.withColumn("begins", begins).select("conv", blocks.alias("blocks"))
    formatted = F.array_join(
        F.transform(
            "blocks",
            lambda b: F.concat(F.lit("<turn "), b["role"], F.lit(">"), F.array_join(b["texts"], "<next>"), F.lit("</turn>\n")),
        ),
        "",
    )
    runs = F.flatten(
        F.transform(
            "blocks",
            lambda b: F.concat(
                F.transform(
                    b["texts"],
                    lambda t, i: F.struct(
                        (F.when(i == 0, F.length(b["role"]) + 7).otherwise(F.lit(6)) + F.when(b["role"] == LEARNED, 0).otherwise(F.length(t))).alias("skip"),
                        F.when(b["role"] == LEARNED, F.length(t)).otherwise(F.lit(0)).alias("take"),
                    ),
                ),
                F.array(F.struct(F.lit(8).alias("skip"), F.lit(0).alias("take"))),
            ),
        )
    )
    return merged.select(F.col("conv").alias(conv), formatted.alias("formatted"), runs.alias("loss_runs"))


def _marks(formatted: Column) -> Column:
    """The formatted text, cut before every mark."""
    return F.split(formatted, "(?=<)")


def _behind(piece: Column) -> Column:
    """What follows the mark a piece begins with."""
    return F.substring(piece, F.instr(piece, ">") + 1, F.length(piece))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> of the turns in a formatted conversation."""
    blocks = F.filter(F.split(formatted, "</turn>\n"), lambda b: b != "")
    # the role of a block is looked for once, however many turns were merged into it
    parts = F.transform(
        blocks, lambda b: F.struct(unescape(F.regexp_extract(b, "^<turn ([^>]*)>", 1)).alias("role"), _marks(b).alias("pieces"))
    )
    return F.flatten(
        F.transform(parts, lambda s: F.transform(s["pieces"], lambda p: F.struct(s["role"].alias("role"), unescape(_behind(p)).alias("text"))))
    )


def read_loss(formatted: Column, loss_runs: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    pieces = F.zip_with(_marks(formatted), loss_runs, lambda p, r: F.substring(p, r["skip"] + 1, r["take"]))
    return F.array_join(F.transform(pieces, unescape), "")
