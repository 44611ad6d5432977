r"""Conversations as training text: a state machine over roles, and a template with loss flags.

All of it is column expressions. Rows are grouped by conversation, ordered by
turn, checked by a state machine, and written as segments of text, each with a
loss flag; the formatted conversation is the segments joined.

The template marks each turn by a control string before and after it. Inside a
text, each backslash is doubled and each control string is broken up by a
backslash after its first character, so no control string stands in a text and
``\x`` always reads back as ``x``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    """What stands around the text of a role, and whether the text is learnt."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks per role, and the turn orders that count as valid.

    A role without marks of its own gets ``other``, where ``{role}`` stands for
    its escaped name. ``steps`` gives the next state for (state, role); a pair
    that is missing, and an end in a state outside ``final``, is an error.
    """

    turns: Mapping[str, Turn]
    other: Turn
    steps: Mapping[tuple[str, str], str]
    final: frozenset[str]
    start: str = "start"
    controls: tuple[str, ...] = field(default=())


PLAIN_CHAT = Template(
    turns={
        "system": Turn("<<SYS>>\n", "\n<</SYS>>\n"),
        "user": Turn("[INST] ", " [/INST]\n"),
        "assistant": Turn("<s>", "</s>\n", loss=True),
    },
    other=Turn("[ROLE={role}] ", " [/ROLE]\n"),
    steps={
        ("start", "system"): "asked for",
        ("start", "user"): "asked",
        ("asked for", "user"): "asked",
        ("asked", "assistant"): "answered",
        ("answered", "user"): "asked",
    },
    final=frozenset({"answered", "asked"}),
    controls=("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE=", "[/ROLE]"),
)


def escaped(text: Column, template: Template = PLAIN_CHAT) -> Column:
    """The text with no control string in it."""
    firsts = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in template.controls)
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), firsts, r"$0\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _by_role(role: Column, template: Template, part: str) -> Column:
    known = F.create_map(*chain.from_iterable((F.lit(r), F.lit(getattr(t, part))) for r, t in template.turns.items()))
    if part == "loss":
        return F.coalesce(known[role], F.lit(template.other.loss))
    head, _, tail = getattr(template.other, part).partition("{role}")
    named = F.concat(F.lit(head), F.regexp_replace(escaped(role, template), r"\]", r"\\]"), F.lit(tail)) if tail else F.lit(head)
    return F.coalesce(known[role], named)


def end_state(roles: Column, template: Template = PLAIN_CHAT) -> Column:
    """The state after the last turn; ``error`` once a turn has no step."""
    steps = F.create_map(*chain.from_iterable((F.lit(f"{s}\n{r}"), F.lit(t)) for (s, r), t in template.steps.items()))
    return F.aggregate(roles, F.lit(template.start), lambda s, r: F.coalesce(steps[F.concat_ws("\n", s, r)], F.lit("error")))


def format_conversations(rows: DataFrame, template: Template = PLAIN_CHAT) -> DataFrame:
    """(conv_id, valid, segments, formatted), one row per conversation.

    ``rows`` has conv_id, turn, role and text. Turns go by ``turn``, nulls first,
    ties by role and text; repeated rows are turns of their own. A null text or
    role is empty. Rows with a null ``conv_id`` are one conversation. Invalid
    orders are formatted like valid ones, with ``valid`` false. Other columns are
    ignored. A segment is (text, loss, body): markers have ``body`` false.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(F.col("turn"), role.alias("role"), text.alias("text"))
    grouped = rows.select("conv_id", turn.alias("x")).groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("turns"))

    def segments(x: Column) -> Column:
        loss = _by_role(x.role, template, "loss")
        parts = (
            (_by_role(x.role, template, "before"), F.lit(False), F.lit(False)),
            (escaped(x.text, template), loss, F.lit(True)),
            (_by_role(x.role, template, "after"), F.lit(False), F.lit(False)),
        )
        return F.array(*(F.struct(t.alias("text"), w.alias("loss"), b.alias("body")) for t, w, b in parts))

    done = grouped.select(
        "conv_id",
        end_state(F.transform("turns", lambda x: x.role), template).isin(*template.final).alias("valid"),
        F.flatten(F.transform("turns", segments)).alias("segments"),
    )
    return done.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s.text), ""))


def read_back(formatted: Column, template: Template = PLAIN_CHAT) -> Column:
    """array<struct<role, text>> of a formatted conversation."""
    head, _, tail = template.other.before.partition("{role}")
    before = [*(re.escape(t.before) for t in template.turns.values()), f"{re.escape(head)}(?:[^\\\\\\]]++|\\\\.)*+{re.escape(tail)}"]
    after = [re.escape(t.after) for t in (*template.turns.values(), template.other)]
    pattern = f"(?s)({'|'.join(before)})(.*?)(?:{'|'.join(after)})"
    roles = F.create_map(*chain.from_iterable((F.lit(t.before), F.lit(r)) for r, t in template.turns.items()))
    marks, texts = (F.regexp_extract_all(formatted, F.lit(pattern), F.lit(k)) for k in (1, 2))
    named = lambda m: unescaped(F.substr(m, F.lit(len(head) + 1), F.char_length(m) - len(head) - len(tail)))
    return F.zip_with(
        marks, texts, lambda m, t: F.struct(F.coalesce(roles[m], named(m)).alias("role"), unescaped(t).alias("text"))
    )


def conversation_digests(formatted: DataFrame, template: Template = PLAIN_CHAT) -> DataFrame:
    """Counts and digests of each conversation, read back from the formatted output."""
    learnt = F.transform(F.filter("segments", lambda s: s.loss), lambda s: unescaped(s.text))
    read = formatted.select(
        "conv_id", "valid", "formatted", read_back(F.col("formatted"), template).alias("turns"), F.array_join(learnt, "").alias("learnt")
    )
    shown = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(shown, 256).alias("turns_sha256"),
        F.char_length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
