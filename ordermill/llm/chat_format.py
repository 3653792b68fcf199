"""Conversations as training text: turn order checked by a state machine, loss flags per segment.

A ``ChatTemplate`` declares the marks around a turn, which roles are learned,
and the state machine over roles.  ``format_chat`` gives one row per
conversation with its text as a list of segments; each says whether the loss
counts for it.  ``parse_chat`` reads turns back from the formatted text.

Control strings inside texts are escaped reversibly: a backslash is doubled,
and ``<|`` becomes ``<\\|``; after that ``<|`` stands only in the template's own
marks.  Between ``<`` and ``|`` an escaped text has an even number of backslashes
unless it was escaped there, so reading back is unique.  In roles the line end
that closes the header is escaped too.

Defined results: null text or role counts as empty.  Turns are ordered by
(turn, role, text), nulls first; repeated rows are turns of their own.  Rows
with a null conversation id form one conversation.  A conversation that breaks
the turn order is formatted all the same, with ``valid`` false and the number of
turns up to the break.  An empty table gives an empty one.  Other columns are not read.

A conversation is one training record, and its digests are over the whole of
it, so its turns meet in one row; nothing else is gathered.  DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """Marks must begin with ``<|``; transitions lead from (state, role) to the next state."""

    start: str = "<|im_start|>"
    header_end: str = "\n"
    end: str = "<|im_end|>\n"
    learned_roles: tuple[str, ...] = ("assistant",)
    first_state: str = "begin"
    transitions: tuple[tuple[str, str, str], ...] = (
        ("begin", "system", "instructed"), ("begin", "user", "asked"), ("instructed", "user", "asked"),
        ("asked", "assistant", "answered"), ("answered", "user", "asked"),
    )
    accepting: tuple[str, ...] = ("answered",)


REFUSED = "refused"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    opened = F.replace(text, F.lit("<\\|"), F.lit("<|"))
    return F.replace(opened, F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\~"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\~"), F.lit("\n")))


def _machine(turns: Column, template: ChatTemplate) -> Column:
    """(state after the last turn, turns taken before the order broke)."""
    pairs = [F.lit(x) for state, role, after in template.transitions for x in (f"{state}\n{role}", after)]
    table = F.create_map(*pairs)
    begin = F.struct(F.lit(template.first_state).alias("state"), F.lit(0).alias("taken"))

    def step(at: Column, turn: Column) -> Column:
        after = F.coalesce(F.try_element_at(table, F.concat(at["state"], F.lit("\n"), turn["role"])), F.lit(REFUSED))
        return F.struct(after.alias("state"), (at["taken"] + F.when(after == REFUSED, 0).otherwise(1)).alias("taken"))

    return F.aggregate(turns, begin, step)


def format_chat(rows: DataFrame, template: ChatTemplate = ChatTemplate(), conv_col: str = "conv_id",
                turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, n_turns (long), valid, valid_turns, segments array<struct<text, loss>>."""
    empty = F.lit("")
    turns = F.sort_array(F.collect_list(F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), empty).alias("role"),
        F.coalesce(F.col(text_col), empty).alias("text"))))
    conversations = rows.groupBy(F.col(conv_col).alias("conv_id")).agg(turns.alias("turns"))
    learned = list(template.learned_roles)

    def segments(turn: Column) -> Column:
        def piece(text: Column, loss: Column) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"))

        header = F.concat(F.lit(template.start), escape_role(turn["role"]), F.lit(template.header_end))
        return F.array(
            piece(header, F.lit(False)), piece(escape(turn["text"]), turn["role"].isin(learned)),
            piece(F.lit(template.end), F.lit(False)))

    checked = conversations.withColumn("machine", _machine(F.col("turns"), template))
    return checked.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.col("machine.state").isin(list(template.accepting)).alias("valid"),
        F.col("machine.taken").alias("valid_turns"),
        F.flatten(F.transform("turns", segments)).alias("segments"))


def formatted_text(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def loss_text(segments: Column) -> Column:
    """All text that the loss counts for, in order, as it was before escaping."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def parse_chat(formatted: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """array<struct<role, text>> read back from a formatted conversation."""
    pieces = F.split(formatted, r"\Q" + template.start + r"\E")

    def turn(piece: Column) -> Column:
        header = F.substring_index(piece, template.header_end, 1)
        before = F.length(header) + len(template.header_end)
        body = F.substr(piece, before + 1, F.length(piece) - before - len(template.end))
        return F.struct(unescape_role(header).alias("role"), unescape(body).alias("text"))

    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), turn)
