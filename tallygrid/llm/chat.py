"""Chat formatting: roles checked by a finite-state machine, text segments with loss flags.

DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """What a formatted conversation looks like, and which role may follow which.

    Every control string begins with `<|`. In a text, `<`, n backslashes and `|` become `<`, n+1
    backslashes and `|`, so that no text holds a control string, and dropping one backslash
    restores it. A role is escaped alike; its line breaks become `<n|`.
    """

    turn_open: str = "<|im_start|>"
    role_end: str = "\n"
    turn_close: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    accepting: tuple[str, ...] = ("assistant",)
    #: state -> role that may come next -> next state
    transitions: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "system", "user": "user"},
            "system": {"user": "user"},
            "user": {"assistant": "assistant"},
            "assistant": {"user": "user", "tool": "user"},
        }
    )


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.regexp_replace(role, r"<(\\*)(n?)\|", r"<\\$1$2|"), F.lit("\n"), F.lit("<n|"))


def unescape_role(role: Column) -> Column:
    return F.regexp_replace(F.replace(role, F.lit("<n|"), F.lit("\n")), r"<\\(\\*)(n?)\|", r"<$1$2|")


def format_chats(rows: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Rows (conv_id, turn, role, text) to one row per conversation.

    Returns conv_id, n_turns, valid, error_turn (the position of the first turn out of order,
    null if none), segments array<struct<text, loss>> and formatted, the segments joined.
    A null text or role is empty. Turns of equal number come in order of role, then text;
    repeated rows are turns of their own; null conv_ids form one conversation. A conversation
    that breaks the order is kept whole with valid false. Columns other than the four are
    ignored. An empty table gives an empty result.
    """
    joined = rows.select(
        "conv_id",
        F.struct(
            F.col("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("t"),
    )
    turns = joined.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    steps = {f"{s}\n{role}": to for s, nexts in template.transitions.items() for role, to in nexts.items()}
    moves = F.create_map(*(F.lit(x) for pair in steps.items() for x in pair))

    def step(state: Column, turn: Column) -> Column:
        to = moves[F.concat(state["state"], F.lit("\n"), turn["role"])]
        return F.struct(
            # After a turn out of order the machine goes on from the role it saw.
            F.coalesce(to, turn["role"]).alias("state"),
            (state["seen"] + 1).alias("seen"),
            F.coalesce(state["error"], F.when(to.isNull(), state["seen"])).alias("error"),
        )

    start = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("seen"), F.lit(None).cast("int").alias("error"))
    end = F.aggregate("turns", start, step)

    def parts(turn: Column) -> Column:
        segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        head = F.concat(F.lit(template.turn_open), escape_role(turn["role"]), F.lit(template.role_end))
        return F.array(
            segment(head, F.lit(False)),
            segment(escape_text(turn["text"]), turn["role"].isin(*template.loss_roles)),
            segment(F.lit(template.turn_close), F.lit(False)),
        )

    return (
        turns.select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            end.alias("end"),
            F.flatten(F.transform("turns", parts)).alias("segments"),
        )
        .select(
            "conv_id",
            "n_turns",
            (F.col("end.error").isNull() & F.col("end.state").isin(*template.accepting)).alias("valid"),
            F.col("end.error").alias("error_turn"),
            "segments",
            F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        )
    )


def read_chats(formatted: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Parse formatted conversations back: adds turns array<struct<role, text>> and loss_text."""
    mark = "".join("\\" + c if not c.isalnum() else c for c in template.turn_open)
    blocks = F.split("formatted", mark)
    inner = F.slice(blocks, F.lit(2), F.greatest(F.size(blocks) - 1, F.lit(0)))

    def parse(block: Column) -> Column:
        role = F.substring_index(block, template.role_end, 1)
        at = F.char_length(role) + len(template.role_end) + 1
        size = F.char_length(block) - at + 1 - len(template.turn_close)
        return F.struct(
            unescape_role(role).alias("role"), unescape_text(F.substring(block, at, size)).alias("text")
        )

    return formatted.withColumn("turns", F.transform(inner, parse)).withColumn(
        "loss_text",
        F.array_join(
            F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape_text(s["text"])), ""
        ),
    )


def turn_digests(parsed: DataFrame) -> DataFrame:
    """The digest columns of parsed conversations."""
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return parsed.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
