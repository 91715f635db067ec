"""Chat formatting with Spark expressions only.

A conversation's rows are collected as structs and sorted by turn.
Neighbouring rows of one role become one turn: a header, the parts with a
separator between them, and an end mark.  Control strings inside roles and
texts are broken by a backslash after their first character, and their own
backslashes doubled, so that the formatted text can be read back.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks of a chat format, and control strings of other formats that a text must not bring in."""

    start: str = "<|turn|>"
    head: str = "<|says|>"
    part: str = "<|part|>"
    end: str = "<|done|>"
    foreign: tuple[str, ...] = field(default=(
        "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
        "<|startoftext|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>"))

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.start, self.head, self.part, self.end, *self.foreign)


def escaped(text: Column, template: Template) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in template.controls:
        text = F.replace(text, F.lit(mark), F.lit(f"{mark[0]}\\{mark[1:]}"))
    return text


def unescaped(text: Column) -> Column:
    """A backslash stands for the character after it if that is a backslash, and for nothing otherwise."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _pieces(text: Column, mark: str) -> Column:
    return F.split(text, f"\\Q{mark}\\E", -1)


def format_chats(rows: DataFrame, template: Template = Template(), loss_role: str = "assistant",
                 conv_col: str = "conv_id") -> DataFrame:
    """(conv_id, segments, formatted) of every conversation.

    ``rows`` has conv_id, turn, role and text.  Rows are ordered by turn
    (null first), then role and text; equal rows all stay.  A null role or
    text is empty; rows with a null conv_id are one conversation.
    ``formatted`` is what the segments (text, loss) give together; ``loss``
    marks the escaped texts of ``loss_role``.  Other columns are not read.
    A conversation is one row of the result and has to fit into one.
    """
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    # The head of a turn is known once its rows are sorted; texts are escaped before.
    chats = rows.select(conv_col, turn.alias("t")).groupBy(conv_col).agg(
        F.array_sort(F.collect_list("t")).alias("turns"))
    n = F.size("turns")
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (
        F.get("turns", i)["role"] != F.get("turns", F.greatest(i - 1, F.lit(0)))["role"]))
    chats = chats.withColumn("starts", starts)
    merged = F.transform("starts", lambda s, k: F.struct(
        F.get("turns", s)["role"].alias("role"),
        F.slice("turns", s + 1, F.coalesce(F.get("starts", k + 1), n) - s).alias("parts")))

    def segments(turn: Column) -> Column:
        loss = turn["role"] == loss_role
        mark = F.struct(F.lit(template.part).alias("text"), F.lit(False).alias("loss"))
        parts = F.flatten(F.transform(turn["parts"], lambda p, i: F.array(
            F.when(i > 0, mark),
            F.struct(escaped(p["text"], template).alias("text"), loss.alias("loss")))))
        head = F.concat(F.lit(template.start), escaped(turn["role"], template), F.lit(template.head))
        return F.concat(
            F.array(F.struct(head.alias("text"), F.lit(False).alias("loss"))), F.filter(parts, lambda s: s.isNotNull()),
            F.array(F.struct(F.lit(template.end).alias("text"), F.lit(False).alias("loss"))))

    chats = chats.select(conv_col, F.flatten(F.transform(merged, segments)).alias("segments"))
    return chats.select(conv_col, "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias(
        "formatted"))


def read_back(formatted: Column, template: Template = Template()) -> Column:
    """The rows (role, text) that ``formatted`` was made of."""
    turns = F.filter(_pieces(formatted, template.end), lambda t: t != "")

    def rows(turn: Column) -> Column:
        both = _pieces(F.substring(turn, len(template.start) + 1, 2**31 - 1), template.head)
        return F.transform(_pieces(both[1], template.part), lambda p: F.struct(
            unescaped(both[0]).alias("role"), unescaped(p).alias("text")))

    return F.flatten(F.transform(turns, rows))


def loss_text(segments: Column) -> Column:
    """What stands under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
