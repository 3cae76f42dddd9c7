"""Chat formatting: a finite-state machine over roles and a declarative template with loss flags.

A template gives each role its opening and closing marker and says whether its text bears loss. Texts
are escaped, so no control string of the template can occur inside one, and ``read_back`` recovers
every turn from the formatted string alone. All of it is DataFrame expressions.

Defined results: turns are ordered by turn (null first), then role, then text; repeated rows are turns
of their own. A null text is empty, a null role is the empty role name; a role the template does not
name is written with its name (escaped as well) and bears no loss. A conversation that the machine
rejects is formatted like any other and has ``valid`` false and ``error_turn``, the place of the first
turn out of order. Rows without conv_id form one conversation. A conversation is one training example
and so one row: it is the unit that must fit a task.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: The state no move leaves.
REJECTED = ""


@dataclass(frozen=True)
class Markers:
    opening: str
    closing: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``other`` wraps roles the template does not name; its role name ends at ``name_end``."""

    roles: Mapping[str, Markers]
    other: Markers
    name_end: str
    start: str
    moves: Mapping[tuple[str, str], str]
    accepting: tuple[str, ...]
    escape: str = "\\"
    extra_controls: tuple[str, ...] = field(default=())

    @property
    def controls(self) -> list[str]:
        """Every string that structures the output, longest first."""
        marks = [*self.roles.values(), self.other]
        found = {m.opening for m in marks} | {m.closing for m in marks}
        found |= {self.name_end, *self.extra_controls}
        return sorted(found - {""}, key=lambda c: (-len(c), c))


INSTRUCT = Template(
    roles={
        "system": Markers("[SYS]", "[/SYS]"),
        "user": Markers("[INST]", "[/INST]"),
        "assistant": Markers("<s>", "</s>", loss=True),
    },
    other=Markers("[ROLE]", "[/ROLE]"),
    name_end="[/NAME]",
    start="begin",
    moves={
        ("begin", "system"): "instructed",
        ("begin", "user"): "asked",
        ("instructed", "user"): "asked",
        ("asked", "assistant"): "answered",
        ("answered", "user"): "asked",
    },
    accepting=("asked", "answered"),
)


def escaped(text: Column, template: Template) -> Column:
    """Doubles the escape character, then breaks each control string after its first character."""
    mark = template.escape
    text = F.replace(text, F.lit(mark), F.lit(mark * 2))
    for control in template.controls:
        text = F.replace(text, F.lit(control), F.lit(control[0] + mark + control[1:]))
    return text


def unescaped(text: Column, template: Template) -> Column:
    """A doubled escape character is one, a single one is nothing."""
    mark = "\\Q" + template.escape + "\\E"
    return F.regexp_replace(text, f"{mark}({mark})?", "$1")


def _written_turn(turn: Column, template: Template) -> Column:
    """The segments of one turn: marker, text, marker, each with its loss flag."""

    def segments(opening: Column, text: Column, marks: Markers) -> Column:
        parts = [(opening, False), (text, marks.loss), (F.lit(marks.closing), False)]
        return F.array(*[F.struct(t.alias("text"), F.lit(f).alias("loss")) for t, f in parts])

    text = escaped(turn["text"], template)
    name = escaped(turn["role"], template)
    other = F.concat(F.lit(template.other.opening), name, F.lit(template.name_end))
    found = segments(other, text, template.other)
    for role, marks in template.roles.items():
        plain = segments(F.lit(marks.opening), text, marks)
        found = F.when(turn["role"] == role, plain).otherwise(found)
    return found


def _run_machine(turns: Column, template: Template) -> Column:
    """State after the last turn and the place of the first turn without a move (0: none)."""
    start = F.struct(
        F.lit(template.start).alias("state"), F.lit(0).alias("seen"), F.lit(0).alias("error")
    )

    def step(at: Column, turn: Column) -> Column:
        target = F.lit(REJECTED)
        for (state, role), to in template.moves.items():
            target = F.when((at["state"] == state) & (turn["role"] == role), to).otherwise(target)
        seen = at["seen"] + 1
        error = F.when((at["error"] == 0) & (target == REJECTED), seen).otherwise(at["error"])
        return F.struct(target.alias("state"), seen.alias("seen"), error.alias("error"))

    return F.aggregate(turns, start, step)


def format_chats(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per conversation: conv_id, valid, error_turn, segments and the formatted string."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = F.struct(F.col("turn").alias("turn"), role.alias("role"), text.alias("text"))
    chats = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("turns"))
    segments = F.flatten(F.transform("turns", lambda t: _written_turn(t, template)))
    end = _run_machine(F.col("turns"), template)
    chats = chats.select("conv_id", segments.alias("segments"), end.alias("end"))
    accepted = (F.col("end.error") == 0) & F.col("end.state").isin(*template.accepting)
    return chats.select(
        "conv_id",
        F.coalesce(accepted, F.lit(False)).alias("valid"),
        F.col("end.error").alias("error_turn"),
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
    )


def read_back(chats: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """``chats`` with ``turns`` (role, text), read from the formatted string alone."""

    def quoted(text: str) -> str:
        return "\\Q" + text + "\\E"

    marks = [*template.roles.values(), template.other]
    pattern = "(?s)" + "|".join(f"{quoted(m.opening)}.*?{quoted(m.closing)}" for m in marks)
    written = F.regexp_extract_all(F.col("formatted"), F.lit(pattern), F.lit(0))

    def inner(text: Column, marks: Markers) -> Column:
        size = F.length(text) - len(marks.opening) - len(marks.closing)
        return F.substring(text, F.lit(len(marks.opening) + 1), size)

    def turn(text: Column) -> Column:
        body = inner(text, template.other)
        role = F.substring_index(body, template.name_end, 1)
        rest = F.substring(
            body, F.length(role) + len(template.name_end) + 1, F.length(body)
        )
        for name, marks in template.roles.items():
            fits = F.startswith(text, F.lit(marks.opening))
            role = F.when(fits, F.lit(name)).otherwise(role)
            rest = F.when(fits, inner(text, marks)).otherwise(rest)
        return F.struct(
            unescaped(role, template).alias("role"), unescaped(rest, template).alias("text")
        )

    return chats.withColumn("turns", F.transform(written, turn))


def loss_text(template: Template = INSTRUCT) -> Column:
    """All text under the loss mask of ``segments``, unescaped, nothing between."""
    kept = F.filter("segments", lambda s: s["loss"])
    return F.array_join(F.transform(kept, lambda s: unescaped(s["text"], template)), "")
