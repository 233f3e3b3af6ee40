"""Chat logs to training text: fold events into messages, render them, and read the text back.

Only DataFrame functions: grouping, arrays and strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNT_ROLE = "assistant"
#: Kinds of events. A delta adds to its message; each other kind sets the whole text anew.
MESSAGE, DELTA, EDIT, REGENERATE = "message", "delta", "edit", "regenerate"


def escape(text: Column) -> Column:
    """No control string is left: backslashes double, and `<|` gets one between its signs."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """A role must also stay on its line; after `<`, one backslash only ever comes from escaping."""
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n"), F.lit("\n")))


def fold(events: DataFrame) -> DataFrame:
    """Events (conv, msg, seq, kind, role, text) to messages (conv, seq, role, text).

    Of each message the last event that sets the text counts, with the deltas from its seq on, in
    order of seq; earlier deltas belong to a text that was given up. A message never set is its
    deltas. It stands where its first event does; its role is the last one that is not null. Null
    texts are empty, null kinds are messages, null seqs come first. Of setting events that tie in seq
    the greatest text counts; deltas that tie go by text, each repeated one counts. Events are dealt
    by conversation and message, so a long conversation is many groups; one message is one row.
    """
    cleaned = events.select(
        "conv", "msg", F.coalesce("seq", F.lit(-(1 << 62))).alias("seq"),
        (F.coalesce("kind", F.lit(MESSAGE)) != DELTA).alias("sets"), "role", F.coalesce("text", F.lit("")).alias("text"),
    )
    folded = cleaned.groupBy("conv", "msg").agg(
        F.min("seq").alias("seq"),
        F.max(F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).alias("named"),
        F.max(F.when(F.col("sets"), F.struct("seq", "text"))).alias("base"),
        F.collect_list(F.when(~F.col("sets"), F.struct("seq", "text"))).alias("deltas"),
    )
    live = F.filter("deltas", lambda d: F.col("base").isNull() | (d["seq"] >= F.col("base")["seq"]))
    return folded.select(
        "conv", "seq", F.coalesce(F.col("named.role"), F.lit("")).alias("role"),
        F.concat(
            F.coalesce(F.col("base.text"), F.lit("")), F.array_join(F.transform(F.sort_array(live), lambda d: d["text"]), "")
        ).alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """Messages (conv, seq, role, text) to (conv, formatted, loss), one row per conversation.

    loss: spans (turn, start, length) of the text to learn, in code points of that turn's piece of
    `formatted`, from 1: the assistant's texts without markers. Turns that tie in seq go by role and text.
    """
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    pieces = messages.select(
        "conv",
        F.struct(
            "seq", "role", "text",
            F.concat(head, body, F.lit(END)).alias("piece"),
            F.when(F.col("role") == LEARNT_ROLE, F.struct((F.char_length(head) + 1).alias("start"), F.char_length(body).alias("length"))).alias("span"),
        ).alias("turn"),
    )
    turns = pieces.groupBy("conv").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    spans = F.transform("turns", lambda t, i: F.struct(i.alias("turn"), t["span"]["start"].alias("start"), t["span"]["length"].alias("length")))
    return turns.select(
        "conv",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.filter(spans, lambda s: s["start"].isNotNull()).alias("loss"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """(conv, formatted, loss) to (conv, formatted, turns, learnt): what the formatted text says.

    turns: (role, text) as they were before escaping; learnt: the texts under the loss mask.
    """
    pieces = F.slice(F.split("formatted", r"<\|im_end\|>\n"), 1, F.size(F.split("formatted", r"<\|im_end\|>\n")) - 1)

    def turn(piece):
        line = F.substring_index(piece, "\n", 1)
        return F.struct(
            unescape_role(F.substr(line, F.lit(len(START) + 1))).alias("role"),
            unescape(F.substr(piece, F.char_length(line) + 2)).alias("text"),
        )

    return rendered.withColumn("_pieces", pieces).select(
        "conv", "formatted",
        F.transform("_pieces", turn).alias("turns"),
        F.transform("loss", lambda s: unescape(F.substr(F.element_at("_pieces", s["turn"] + 1), s["start"], s["length"]))).alias("learnt"),
    )


def digests(read: DataFrame) -> DataFrame:
    """Counts and digests of what was read back, one row per conversation."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join("learnt", "")
    return read.select(
        "conv",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def format_chats(events: DataFrame) -> DataFrame:
    """Events to (conv, formatted, loss): fold, then render. An empty table gives an empty one."""
    return render(fold(events))
