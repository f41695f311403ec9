"""Chat formatting by relational operations: turn structs are collected and sorted, adjacent
turns of one role become one block, and blocks are concatenated. Spark expressions only.

A block is ``<|im_start|>role\\n``, the texts of its turns with ``<|im_sep|>`` between them, and
``<|im_end|>\\n``. Inside roles and texts a backslash is written twice and ``<|`` becomes
``<\\|``, so no text can hold a control string and the change can be undone; a line break inside
a role becomes ``\\n``.

Defined results: a NULL text or role counts as empty; turns are ordered by turn (NULL first), then
role, then text, so ties and repeated rows have a fixed order and all stay; rows without a
conv_id form one conversation whose id is NULL; an empty table gives an empty table; other
columns are not looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    def part(p: Column) -> Column:
        return F.replace(
            F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\|"), F.lit("|")
        )

    # Splitting at the doubled backslashes first keeps a backslash and an n from a line break.
    return F.array_join(F.transform(F.split(role, r"\\\\"), part), "\\")


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, segments: the text, and the same text in pieces with the loss mask.

    ``turns`` has conv_id, turn, role, text. ``segments`` is an array of (text, loss) whose
    texts, one after the other, are ``formatted``; loss is true for what the model is
    trained on, the assistant's escaped texts.
    """
    each = turns.select(
        "conv_id",
        F.struct(
            F.col("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("t"),
    )
    sorted_turns = each.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # Where a block starts: at the first turn and where the role changes.
    starts = sorted_turns.select(
        "conv_id",
        "turns",
        F.filter(
            F.sequence(F.lit(1), F.size("turns")),
            lambda i: (i == 1)
            | (F.get("turns", i - 1)["role"] != F.get("turns", F.greatest(i - 2, F.lit(0)))["role"]),
        ).alias("starts"),
    )

    def block(start: Column, i: Column) -> Column:
        stop = F.coalesce(F.get("starts", i + 1), F.size("turns") + 1)
        return F.struct(
            F.get("turns", start - 1)["role"].alias("role"),
            F.transform(F.slice("turns", start, stop - start), lambda t: t["text"]).alias("texts"),
        )

    blocks = starts.select("conv_id", F.transform("starts", block).alias("blocks"))

    def segments(b: Column) -> Column:
        loss = b["role"] == TRAINED_ROLE

        def text(t: Column, i: Column) -> Column:
            own = F.struct(escape(t).alias("text"), loss.alias("loss"))
            between = F.struct(F.lit(SEPARATOR).alias("text"), F.lit(False).alias("loss"))
            return F.when(i == 0, F.array(own)).otherwise(F.array(between, own))

        head = F.struct(
            F.concat(F.lit(START), _escape_role(b["role"]), F.lit("\n")).alias("text"),
            F.lit(False).alias("loss"),
        )
        tail = F.struct(F.lit(END + "\n").alias("text"), F.lit(False).alias("loss"))
        return F.concat(
            F.array(head), F.flatten(F.transform(b["texts"], text)), F.array(tail)
        )

    pieces = blocks.select(
        "conv_id", F.flatten(F.transform("blocks", segments)).alias("segments")
    )
    return pieces.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of (role, text), as they came in."""
    blocks = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda b: b != "")

    def turns(b: Column) -> Column:
        role = F.substring_index(b, "\n", 1)
        inner = F.substring(
            b,
            F.length(role) + 2,
            F.length(b) - F.length(role) - 1 - len(END) - 1,
        )
        return F.transform(
            F.split(inner, r"<\|im_sep\|>"),
            lambda t: F.struct(
                _unescape_role(role).alias("role"), unescape(t).alias("text")
            ),
        )

    return F.flatten(F.transform(blocks, turns))


def trained_text(segments: Column) -> Column:
    """All text under the loss mask, with the escapes undone."""
    return F.array_join(
        F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), ""
    )
