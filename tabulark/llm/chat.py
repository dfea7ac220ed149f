"""Conversations as text: a role automaton, marked turns, and a loss flag per segment."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    """How the turns of one role are written, and whether their text is learned."""

    opening: str
    closing: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Declares the written form of a conversation.

    ``controls`` are the strings that mark turns. Their first characters must
    not occur later in any of them, so that no text tail can complete one.
    ``other`` serves roles without an entry; ``{role}`` is replaced by the
    role in URL form.
    """

    begin: str
    turns: dict[str, Turn]
    other: Turn
    controls: tuple[str, ...]
    moves: dict[tuple[str, str], str] = field(default_factory=dict)
    start: str = "start"
    ends: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        firsts = {c[0] for c in self.controls}
        if any(ch in firsts or ch == "\\" for c in self.controls for ch in c[1:]):
            raise ValueError("the first character of a control string must not stand inside one")


#: Marks in square brackets, with text after one blank; assistant texts are learned.
INSTRUCT = Template(
    begin="<s>",
    turns={
        "system": Turn("[SYS] ", " [/SYS]"),
        "user": Turn("[INST] ", " [/INST]"),
        "assistant": Turn("[OUT] ", " </s>", loss=True),
    },
    other=Turn("[ROLE={role}] ", " [/ROLE]"),
    controls=("<s>", "</s>", "[SYS]", "[/SYS]", "[INST]", "[/INST]", "[OUT]", "[ROLE=", "[/ROLE]"),
    moves={
        ("start", "system"): "system",
        ("start", "user"): "user",
        ("system", "user"): "user",
        ("user", "assistant"): "assistant",
        ("assistant", "user"): "user",
    },
)


def escaped(text: Column, template: Template) -> Column:
    """One backslash more after the first character of every control string."""
    heads = {c[0] for c in template.controls}
    for head in sorted(heads):
        rests = "|".join(re.escape(c[1:]) for c in sorted(template.controls) if c[0] == head)
        text = F.regexp_replace(text, f"{re.escape(head)}(\\\\*)({rests})", _java(head) + "\\\\$1$2")
    return text


def unescaped(text: Column, template: Template) -> Column:
    """One backslash less; the inverse of :func:`escaped`."""
    heads = {c[0] for c in template.controls}
    for head in sorted(heads):
        rests = "|".join(re.escape(c[1:]) for c in sorted(template.controls) if c[0] == head)
        text = F.regexp_replace(text, f"{re.escape(head)}\\\\(\\\\*)({rests})", _java(head) + "$1$2")
    return text


def _java(literal: str) -> str:
    return literal.replace("\\", "\\\\").replace("$", "\\$")


def _by_role(role: Column, template: Template, known, other: Column) -> Column:
    cases = [F.when(role == name, known(turn)) for name, turn in template.turns.items()]
    return F.coalesce(*cases, other)


def _openings(role: Column, template: Template) -> Column:
    before, after = template.other.opening.split("{role}")
    other = F.concat(F.lit(before), F.url_encode(role), F.lit(after))
    return _by_role(role, template, lambda t: F.lit(t.opening), other)


def run_automaton(roles: Column, template: Template) -> Column:
    """Struct of the last state and the first turn (from 0) that the automaton refuses, else null."""
    moves = F.create_map(*[F.lit(x) for (state, role), to in template.moves.items() for x in (f"{state}\n{role}", to)])
    begin = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("refused"))

    def step(now: Column, role: Column) -> Column:
        to = F.element_at(moves, F.concat(now["state"], F.lit("\n"), role))
        return F.struct(
            F.coalesce(to, now["state"]).alias("state"),
            (now["at"] + 1).alias("at"),
            F.coalesce(now["refused"], F.when(to.isNull(), now["at"])).alias("refused"),
        )

    return F.aggregate(roles, begin, step)


def format_conversations(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    template: Template = INSTRUCT,
) -> DataFrame:
    """One row per conversation: the key, ``segments``, ``formatted``, ``valid`` and ``refused_turn``.

    ``segments`` are (text, loss) in order; together they are ``formatted``.
    The automaton of the template judges the order of roles: ``valid`` says
    that it took every turn and stopped in an end state, ``refused_turn`` is
    the first turn it refused. Refused conversations are written all the same.

    Control strings inside a text get a backslash after their first character
    (one more, if there are some), so marks are recognised without doubt and
    :func:`read_turns` gives back the very texts.

    Defined cases: a null text or role is the empty string; turns are ordered
    by (turn, role, text), null first, so repeated turn numbers have one order
    and repeated rows all stay; rows without a conversation id form one
    conversation; other columns are ignored; an empty table gives no rows.
    A conversation becomes one row, so its texts meet in one task; conversations
    are spread over tasks by their id.
    """
    said = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    grouped = turns.groupBy(F.col(conversation).alias(conversation)).agg(F.sort_array(F.collect_list(said)).alias("_turns"))

    def written(t: Column) -> Column:
        who = t["role"]
        closing = _by_role(who, template, lambda x: F.lit(x.closing), F.lit(template.other.closing))
        loss = _by_role(who, template, lambda x: F.lit(x.loss), F.lit(template.other.loss))
        off = F.lit(False)
        return F.array(
            F.struct(_openings(who, template).alias("text"), off.alias("loss")),
            F.struct(escaped(t["text"], template).alias("text"), loss.alias("loss")),
            F.struct(closing.alias("text"), off.alias("loss")),
        )

    begin = F.array(F.struct(F.lit(template.begin).alias("text"), F.lit(False).alias("loss")))
    judged = grouped.select(
        conversation,
        F.concat(begin, F.flatten(F.transform("_turns", written))).alias("segments"),
        run_automaton(F.transform("_turns", lambda t: t["role"]), template).alias("_run"),
    )
    return judged.select(
        conversation,
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        (F.col("_run.refused").isNull() & F.col("_run.state").isin(*template.ends)).alias("valid"),
        F.col("_run.refused").alias("refused_turn"),
    )


def read_turns(formatted: Column, template: Template = INSTRUCT) -> Column:
    """The (role, text) turns read back from a formatted conversation."""
    before, after = template.other.opening.split("{role}")
    openings = [t.opening.strip() for t in template.turns.values()] + [before.strip()]
    body = F.substr(formatted, F.lit(len(template.begin) + 1))
    parts = F.filter(F.split(body, f"(?={'|'.join(re.escape(o) for o in openings)})", -1), lambda p: p != "")

    def inner(part: Column, opening: Column, closing: str) -> Column:
        raw = F.substr(part, opening + 1, F.length(part) - opening - len(closing))
        return unescaped(raw, template)

    def turn(part: Column) -> Column:
        name = F.url_decode(F.regexp_extract(part, f"^{re.escape(before)}([^{re.escape(after[0])}]*)", 1))
        head = F.locate(after, part) + len(after) - 1
        other = F.struct(name.alias("role"), inner(part, head, template.other.closing).alias("text"))
        cases = [
            F.when(
                F.startswith(part, F.lit(t.opening)),
                F.struct(F.lit(r).alias("role"), inner(part, F.lit(len(t.opening)), t.closing).alias("text")),
            )
            for r, t in template.turns.items()
        ]
        return F.coalesce(*cases, other)

    return F.transform(parts, turn)


def learned_text(segments: Column, template: Template = INSTRUCT) -> Column:
    """All text under the loss flags, unescaped, nothing between."""
    learned = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learned, lambda s: unescaped(s["text"], template)), "")
