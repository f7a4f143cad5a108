"""Conversations as training texts with a loss mask, in Spark expressions alone.

The turns of a conversation are collected as structs and sorted, adjacent turns of one role become
one block, and blocks are joined to one text::

    ### user: first text<next/>second text</turn>
    ### assistant: answer</turn>

A block opens with a header, texts that were turns of their own stay apart by a mark, and a block
ends with another. These control strings cannot occur in a text: they are escaped there by a
backslash and a letter, and the backslash itself likewise, so that :func:`read_back` gives every
turn again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepost.functions.binding import bind

OPEN, NEXT, END, AFTER_ROLE = "### ", "<next/>", "</turn>", ": "
LOSS_ROLE = "assistant"
#: What is escaped and by what; the backslash comes first here and last on the way back.
ESCAPES = (("\\", "\\s"), (OPEN, "\\h"), (NEXT, "\\n"), (END, "\\e"))
ROLE_ESCAPES = (*ESCAPES, (AFTER_ROLE, "\\c"))


def escaped(text: Column, escapes: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for plain, mark in escapes:
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescaped(text: Column, escapes: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for plain, mark in reversed(escapes):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def _joined(parts: Column) -> Column:
    return F.array_join(parts, "")


def _blocks(turns: Column) -> Column:
    """Runs of turns with one role: an array of (role, texts)."""

    def of_starts(turns: Column, starts: Column) -> Column:
        def block(at: Column, k: Column) -> Column:
            end = F.coalesce(F.get(starts, k + 1), F.size(turns))
            texts = F.transform(F.slice(turns, at + 1, end - at), lambda turn: turn["text"])
            return F.struct(F.get(turns, at)["role"].alias("role"), texts.alias("texts"))

        return F.transform(starts, block)

    def starts_of(turns: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(turns) - 1)
        return F.filter(places, lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]))

    return bind(turns, lambda held: bind(starts_of(held), lambda starts: of_starts(held, starts)))


def _segments(blocks: Column, loss_role: str) -> Column:
    """The text of all blocks in parts, each with whether it is trained on."""
    target = escaped(F.lit(loss_role), ROLE_ESCAPES)

    def part(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def of_block(block: Column) -> Column:
        off = F.lit(False)
        head = F.array(part(F.concat(F.lit(OPEN), block["role"], F.lit(AFTER_ROLE)), off))
        texts = F.transform(
            block["texts"],
            lambda text, i: F.array(part(F.when(i > 0, NEXT).otherwise(""), off), part(text, block["role"] == target)),
        )
        return F.concat(head, F.flatten(texts), F.array(part(F.lit(END + "\n"), off)))

    return F.flatten(F.transform(blocks, of_block))


def format_conversations(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """``conv_id, n_blocks, segments, text``: one row for each conversation.

    ``turns`` has ``conv_id, turn, role, text``; ``segments`` are the parts of ``text`` in order,
    each with ``loss``, which is true for the texts of ``loss_role`` and false for all control
    strings. Rows are taken by turn, a null turn last, ties by role and text; rows that repeat are
    turns of their own. A null text or role is empty. Rows with a null ``conv_id`` belong to no
    conversation that is known, so each is one of its own. An empty table gives no rows; other
    columns are not looked at. A conversation is one value of one row, with what that bounds.
    """
    rows = turns.select(
        "conv_id", F.struct(
            F.col("turn").isNull().alias("late"), F.col("turn").alias("turn"),
            escaped(F.coalesce("role", F.lit("")), ROLE_ESCAPES).alias("role"), escaped(F.coalesce("text", F.lit(""))).alias("text"),
        ).alias("row"),
    )
    whole = rows.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("turns"))
    alone = rows.where("conv_id IS NULL").select("conv_id", F.array("row").alias("turns"))
    found = whole.unionByName(alone).select("conv_id", _blocks(F.col("turns")).alias("blocks"))
    found = found.select("conv_id", F.size("blocks").alias("n_blocks"), _segments(F.col("blocks"), loss_role).alias("segments"))
    return found.withColumn("text", _joined(F.transform("segments", lambda s: s["text"])))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns``, the roles and texts read from ``text``, and ``loss_text``, all that is
    trained on, read from ``segments``."""

    def turns_of(block: Column) -> Column:
        def split(at: Column) -> Column:
            role = unescaped(F.substring(block, F.lit(len(OPEN) + 1), at - len(OPEN) - 1), ROLE_ESCAPES)
            texts = F.split(F.substring(block, at + len(AFTER_ROLE), F.length(block)), NEXT, -1)
            return bind(role, lambda r: F.transform(texts, lambda t: F.struct(r.alias("role"), unescaped(t).alias("text"))))

        return bind(F.instr(block, AFTER_ROLE), split)

    blocks = F.filter(F.split("text", END + "\n", -1), lambda block: block != "")
    loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"]))
    return formatted.withColumns({"turns": F.flatten(F.transform(blocks, turns_of)), "loss_text": _joined(loss)})
