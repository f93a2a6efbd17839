"""Chat formatting: a finite-state machine over roles and a declarative template.

A template names, for each role, the text before and after a turn and whether the turn's text is under the loss mask, and
the transitions the role may make. Turns arrive sorted by conversation and stream through the tasks one by one: no
conversation is ever held as a whole, however long it is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Turn:
    """How a role's turn is written; ``after``: the states it may follow ("" is the start)."""

    opening: str
    closing: str
    after: tuple[str, ...]
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Turns by role, and the turn of any other role. Control strings are all openings and closings."""

    start: str
    turns: dict[str, Turn]
    other: Turn
    end_states: tuple[str, ...]
    controls: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        parts = [self.start, *(x for t in [*self.turns.values(), self.other] for x in (t.opening, t.closing))]
        controls = tuple(sorted({x for x in parts if x}, key=lambda x: (-len(x), x)))
        object.__setattr__(self, "controls", controls)
        for a in controls:
            if "\\" in a or len(a) < 2:
                raise ValueError(f"a control string needs two characters and no backslash: {a!r}")
            for b in controls:
                if any(b.startswith(a[i:]) for i in range(1, len(a))) or a != b and a in b:
                    raise ValueError(f"control strings overlap: {a!r}, {b!r}")


#: Instruction template. A system turn may only come first; users and assistants alternate, users first.
INSTRUCT = Template(
    start="<s>",
    turns={
        "system": Turn("[SYS]", "[/SYS]", ("",)),
        "user": Turn("[INST]", "[/INST]", ("", "system", "assistant")),
        "assistant": Turn("[ANS]", "</s>", ("user",), loss=True),
    },
    other=Turn("[TURN]", "[/TURN]", ()),
    end_states=("user", "assistant"),
)


def escape(text: str, template: Template) -> str:
    """``text`` without any control string, not even across its end; ``unescape`` restores it.

    Backslashes are doubled, a backslash is put after the first character of each control string, and one at the end of a
    text that ends like the beginning of a control string.
    """
    text = text.replace("\\", "\\\\")
    for control in template.controls:
        text = text.replace(control, control[0] + "\\" + control[1:])
    if any(text.endswith(c[:n]) for c in template.controls for n in range(1, len(c))):
        text += "\\"
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


@dataclass(frozen=True)
class Segment:
    """A piece of output: escaped text, its loss flag, and whether it is the text of a turn (not a control string)."""

    text: str
    loss: bool
    is_text: bool


class Machine:
    """Reads the turns of one conversation in order and emits segments."""

    def __init__(self, template: Template) -> None:
        self.template, self.state, self.turns, self.bad = template, "", 0, -1

    def read(self, role: str | None, text: str | None) -> list[Segment]:
        template = self.template
        turn = template.turns.get(role or "", template.other)
        if self.state not in turn.after and self.bad < 0:
            self.bad = self.turns
        out = [Segment(template.start, False, False)] if not self.turns and template.start else []
        self.state, self.turns = role or "", self.turns + 1
        name = [] if role in template.turns else [Segment(escape(f"{role or ''}\n", template), False, True)]
        body = Segment(escape(text or "", template), turn.loss, True)
        return [*out, Segment(turn.opening, False, False), *name, body, Segment(turn.closing, False, False)]

    @property
    def valid(self) -> bool:
        return self.bad < 0 and self.state in self.template.end_states


def parse(formatted: str, template: Template) -> Iterator[tuple[str, str]]:
    """Role and text of every turn of a formatted conversation."""
    by_opening = {t.opening: role for role, t in template.turns.items()} | {template.other.opening: None}
    parts = re.split("|".join(f"({re.escape(c)})" for c in template.controls), formatted)
    parts = [x for x in parts if x is not None]
    i = 0
    while i < len(parts):
        if parts[i] in by_opening:
            role, text = by_opening[parts[i]], unescape(parts[i + 1])
            if role is None:
                role, _, text = text.partition("\n")
            yield role, text
            i += 2
        i += 1


_DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
    "valid boolean, bad_turn long"
)
_SEGMENTS = "conv_id long, turn long, seq int, role string, segment string, loss boolean, is_text boolean"


def ordered(conversations: DataFrame) -> DataFrame:
    """Turns of a conversation in one partition and in order: by turn, NULL first, then role and text."""
    turns = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def segments(conversations: DataFrame, template: Template = INSTRUCT, batch_rows: int = 2000) -> DataFrame:
    """One row per output segment: ``conv_id``, ``turn``, ``seq`` (order within the turn), ``role``, ``segment`` (escaped),
    ``loss``, ``is_text``. Joined by conversation, turn order and ``seq`` they are the formatted text.

    NULL text is empty, a NULL or unknown role is written by the template's ``other`` turn with its name as the first
    line. Repeated turns are kept, in the order of role and text. NULL ``conv_id`` is a conversation of its own.
    Other columns are ignored.
    """

    def emit(batches):
        machine, current, out = None, object(), []
        for conv, turn, role, text in _rows(batches):
            if machine is None or conv != current:
                machine, current = Machine(template), conv
            out += [(conv, turn, i, role, s.text, s.loss, s.is_text) for i, s in enumerate(machine.read(role, text))]
            if len(out) >= batch_rows:
                yield _batch(out, _ARROW_SEGMENTS)
                out = []
        if out:
            yield _batch(out, _ARROW_SEGMENTS)

    return ordered(conversations).mapInArrow(emit, _SEGMENTS)


_ARROW_SEGMENTS = pa.schema(
    [("conv_id", pa.int64()), ("turn", pa.int64()), ("seq", pa.int32()), ("role", pa.string()), ("segment", pa.string()), ("loss", pa.bool_()), ("is_text", pa.bool_())]
)
_ARROW_DIGEST = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_()), ("bad_turn", pa.int64())]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def digests(conversations: DataFrame, template: Template = INSTRUCT, batch_rows: int = 2000) -> DataFrame:
    """One row per conversation: what reading the formatted output back gives, as digests, and whether the turn order is
    valid (``bad_turn``: first turn that breaks it, from 0, -1 if none). Cases as in ``segments``."""

    def emit(batches):
        out, machine, current = [], None, object()
        turns = loss = None
        chars = loss_chars = read = 0

        def close():
            out.append((current, read, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, machine.valid, machine.bad))

        for conv, _, role, text in _rows(batches):
            if machine is None or conv != current:
                if machine is not None:
                    close()
                machine, current = Machine(template), conv
                turns, loss, chars, loss_chars, read = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            written = machine.read(role, text)
            formatted = "".join(s.text for s in written)
            chars += len(formatted)
            for found_role, found in parse(formatted, template):
                turns.update(f"{found_role}\n{found}\n".encode())
                read += 1
            masked = "".join(unescape(s.text) for s in written if s.loss)
            loss.update(masked.encode())
            loss_chars += len(masked)
            if len(out) >= batch_rows:
                yield _batch(out, _ARROW_DIGEST)
                out = []
        if machine is not None:
            close()
        if out:
            yield _batch(out, _ARROW_DIGEST)

    return ordered(conversations).mapInArrow(emit, _DIGEST)
