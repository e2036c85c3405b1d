"""Chat formatting by a finite-state machine over roles.

A declarative template gives each role the marks around its text, whether
its text is under the loss mask, and the states it may follow.  The machine
reads a conversation's turns in order, flags turns that are out of order, and
emits text segments with a loss flag each.  Inside texts, control strings
are escaped reversibly, so that the output can be read back.

A conversation streams through one task, turn by turn: only its current turn
is held, so its length doesn't matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmart.llm.common import prepare


@dataclass(frozen=True)
class Role:
    """Marks around a role's text, and what the machine does with it."""

    before: str
    after: str
    loss: bool = False
    follows: tuple[str, ...] = ()  # states; "start" is before the first turn
    ends: bool = False             # a conversation may end here


@dataclass(frozen=True)
class Template:
    """Marks and turn order of a chat format."""

    begin: str = "<s>"
    roles: dict[str, Role] = field(default_factory=lambda: {
        "system": Role("<<SYS>>\n", "\n<</SYS>>\n", follows=("start",)),
        "user": Role("[INST] ", " [/INST]", follows=("start", "system", "assistant")),
        "assistant": Role(" ", "</s>", loss=True, follows=("user",), ends=True),
    })
    #: Marks around the name of a role that the template doesn't know.
    other: tuple[str, str, str] = ("<<ROLE>>", "<</ROLE>>\n", "\n<</TURN>>\n")
    escape: str = "\\"
    control: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
                                "<<ROLE>>", "<</ROLE>>", "<</TURN>>")

    def pattern(self) -> re.Pattern:
        """What has to be escaped in a text."""
        return re.compile("|".join(map(re.escape, (self.escape, *sorted(self.control, key=len, reverse=True)))))


TEMPLATE = Template()


def _escaper(template: Template):
    pattern, mark = template.pattern(), template.escape
    return lambda text: pattern.sub(
        lambda m: m[0] * 2 if m[0] == mark else m[0][0] + mark + m[0][1:], text)


def escape(text: str, template: Template = TEMPLATE) -> str:
    """Break each control string after its first character, and double the
    escape character: the result holds no control string."""
    return _escaper(template)(text)


def unescape(text: str, template: Template = TEMPLATE) -> str:
    """The inverse of ``escape``."""
    return re.sub(re.escape(template.escape) + "(.)", r"\1", text, flags=re.DOTALL)


SEGMENTS = "conv_id long, turn_no long, part int, text string, loss boolean, in_order boolean"


def format_chat(convs: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Segments of every conversation: conv_id, turn_no (from 0), part, text,
    loss, in_order.

    Reads conv_id, turn, role and text.  Turns go by (turn, role, text), so
    that ties and repeated rows have a fixed order.  A null text is empty, a
    null role is the role named by the empty string, a null conv_id is one
    conversation.  ``in_order`` is false from the first turn on that the
    machine refuses, and on the last one if a conversation may not end there.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the turn before, until it is known whether it is the last
        state, good, turn_no, conv, fresh = "start", True, 0, None, True
        escaped = _escaper(template)

        def segments(last: bool) -> list[tuple]:
            if not held:
                return []
            c, n, role, text, ok = held.pop()
            rule = template.roles.get(role)
            body = escaped(text)
            if rule is None:
                name = escaped(role)
                parts = [(template.other[0] + name + template.other[1], False), (body, False), (template.other[2], False)]
            else:
                parts = [(rule.before, False), (body, rule.loss), (rule.after, False)]
                ok = ok and (rule.ends or not last)
            if n == 0:
                parts[0] = (template.begin + parts[0][0], False)
            return [(c, n, i, t, loss, ok) for i, (t, loss) in enumerate(parts)]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) or [()] * 6
            types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.bool_()]
            names = ["conv_id", "turn_no", "part", "text", "loss", "in_order"]
            return pa.record_batch([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

        for batch in batches:
            rows: list[tuple] = []
            for c, role, text in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "role", "text")), strict=True):
                new = fresh or c != conv
                rows += segments(last=new)
                if new:
                    state, good, turn_no, conv, fresh = "start", True, 0, c, False
                role, text = role or "", text or ""
                rule = template.roles.get(role)
                good = good and rule is not None and state in rule.follows
                held.append((c, turn_no, role, text, good))
                state, turn_no = role, turn_no + 1
            yield batch_of(rows)
        yield batch_of(segments(last=True))

    prepare(convs.sparkSession)
    turns = convs.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return (turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(run, SEGMENTS))


class Reader:
    """Reads one conversation's output back, segment by segment."""

    def __init__(self, template: Template = TEMPLATE):
        self.template = template
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.text, self.masked = "", []

    def segment(self, text: str, loss: bool) -> None:
        """The next segment; a turn is read when its end mark has come."""
        self.chars += len(text)
        self.text += text
        if loss:
            self.masked.append(text)
        t = self.template
        body = self.text.removeprefix(t.begin) if self.n_turns == 0 else self.text
        for role, before, after in ((r, x.before, x.after) for r, x in t.roles.items()):
            if body.startswith(before) and body.endswith(after) and len(body) >= len(before) + len(after):
                return self._turn(role, body[len(before):len(body) - len(after)])
        opened, named, closed = t.other
        if body.startswith(opened) and body.endswith(closed):
            name, _, inner = body[len(opened):len(body) - len(closed)].partition(named)
            return self._turn(unescape(name, t), inner)

    def _turn(self, role: str, inner: str) -> None:
        self.turns.update(f"{role}\n{unescape(inner, self.template)}\n".encode())
        for part in self.masked:
            plain = unescape(part, self.template)
            self.loss.update(plain.encode())
            self.loss_chars += len(plain)
        self.n_turns += 1
        self.text, self.masked = "", []


def read_back(segments: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars
    of each conversation, read from the segments' texts and loss flags alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, reader = None, None

        def result(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) or [()] * 6
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.record_batch([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

        def row() -> list[tuple]:
            return [] if reader is None else [(
                conv, reader.n_turns, reader.turns.hexdigest(), reader.loss_chars,
                reader.loss.hexdigest(), reader.chars)]

        for batch in batches:
            rows: list[tuple] = []
            for c, text, loss in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "text", "loss")), strict=True):
                if reader is None or c != conv:
                    rows += row()
                    conv, reader = c, Reader(template)
                reader.segment(text, loss)
            yield result(rows)
        yield result(row())

    prepare(segments.sparkSession)
    return (segments.select("conv_id", "turn_no", "part", "text", "loss")
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn_no", "part")
            .mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                             "loss_sha256 string, formatted_chars long"))
