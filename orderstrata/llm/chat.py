"""Chat formatting: turns to text segments with a loss flag, and back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_AT_ONCE = 4096
SEGMENTS = (
    "conv_id long, turn_no long, part int, text string, loss boolean, valid boolean"
)
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, valid boolean"
)


@dataclass(frozen=True)
class Template:
    """How turns are written, which roles may follow which, and which texts are learnt.

    ``follows`` gives for each state (``""`` at the start, then the last role) the
    roles that may come next; ``final`` the roles a conversation may end with.
    """

    start: str = "<|im_start|>"
    end: str = "<|im_end|>"
    learnt: frozenset[str] = frozenset({"assistant"})
    follows: dict[str, frozenset[str]] = field(
        default_factory=lambda: {
            "": frozenset({"system", "user"}),
            "system": frozenset({"user"}),
            "user": frozenset({"assistant"}),
            "assistant": frozenset({"user"}),
        }
    )
    final: frozenset[str] = frozenset({"assistant"})

    def step(self, state: str | None, role: str) -> str | None:
        """The state after a turn; None once a turn came out of order."""
        allowed = state is not None and role in self.follows.get(state, ())
        return role if allowed else None

    def parts(self, role: str, text: str) -> list[tuple[str, bool]]:
        """Head, body and end of a turn, each with its loss flag."""
        head = f"{self.start}{_escaped_role(role)}\n"
        return [(head, False), (escaped(text), role in self.learnt), (f"{self.end}\n", False)]


# Control strings are written <|...|>. In texts the two characters that open one are
# kept apart by a backslash, one more than there is already.
_OPENING = re.compile(r"<(\\*)\|")
_OPENED = re.compile(r"<\\(\\*)\|")


def escaped(text: str) -> str:
    """``text`` without any control string; ``unescaped`` gives it back."""
    return _OPENING.sub(r"<\\\1|", text)


def unescaped(text: str) -> str:
    return _OPENED.sub(r"<\1|", text)


def _escaped_role(role: str) -> str:
    """A role on one line."""
    return escaped(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _plain_role(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(text))


def _segments(batches: Iterable[pa.RecordBatch], template: Template) -> Iterator[tuple]:
    """Rows of one conversation come one after another, in order."""
    last: object = ()
    state: str | None = ""
    number = 0
    for batch in batches:
        for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if conv != last:
                last, state, number = conv, "", 0
            role, text = role or "", text or ""
            state = template.step(state, role)
            for part, (piece, loss) in enumerate(template.parts(role, text)):
                yield conv, number, part, piece, loss, state is not None
            number += 1


@dataclass
class _Reading:
    """What has been read of a conversation's formatted text."""

    turns: int = 0
    chars: int = 0
    loss_chars: int = 0
    valid: bool = True
    last: str = ""
    rest: str = ""
    loss: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.turns_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, loss: bool, valid: bool, template: Template) -> None:
        self.chars += len(text)
        self.rest += text
        self.valid &= valid
        if loss:
            learnt = unescaped(text)
            self.loss_chars += len(learnt)
            self.loss_hash.update(learnt.encode())
        if not text.startswith(template.end):
            return
        # the text so far ends a turn: find its parts by the control strings alone
        head, mark, tail = self.rest.partition(template.end)
        if not head.startswith(template.start) or not mark or tail != "\n":
            raise ValueError("not in the form that the template writes")
        role, _, body = head[len(template.start) :].partition("\n")
        self.last = _plain_role(role)
        self.turns_hash.update(f"{self.last}\n{unescaped(body)}\n".encode())
        self.turns += 1
        self.rest = ""

    def row(self, conv: int | None, template: Template) -> tuple:
        if self.rest:
            raise ValueError("a turn without its end")
        return (
            conv,
            self.turns,
            self.turns_hash.hexdigest(),
            self.loss_chars,
            self.loss_hash.hexdigest(),
            self.chars,
            self.valid and self.last in template.final,
        )


def _batches(rows: Iterable[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        arrays = [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, [n for n, _ in fields])

    for row in rows:
        held.append(row)
        if len(held) == ROWS_AT_ONCE:
            yield batch()
            held = []
    if held:
        yield batch()


def _in_order(conversations: DataFrame, conv, turn, role, text) -> DataFrame:
    rows = conversations.select(
        F.col(conv).cast("long"), F.col(turn), F.col(role), F.col(text)
    ).toDF("conv_id", "turn", "role", "text")
    placed = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return placed.select("conv_id", "role", "text")


def format_turns(
    conversations: DataFrame,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    template: Template | None = None,
) -> DataFrame:
    """Three segments a turn, in order of ``turn_no`` and ``part``: head, body, end.

    The formatted conversation is the segments' ``text`` one after another; ``loss``
    says whether a segment is learnt. Control strings inside texts and roles are
    escaped, so that the text can be taken apart again. ``valid`` is false from the
    first turn on that the template's state machine does not allow; such turns are
    formatted like others. Turns go by number, NULL first; equal numbers by role and
    text. NULL roles and texts count as empty, a NULL conversation id is one
    conversation, a repeated row is a turn of its own. Other columns play no part. An
    empty table gives an empty one. A task reads its conversations turn by turn, so a
    long one takes time but no memory.
    """
    template = template or Template()
    rows = _in_order(conversations, conv_column, turn_column, role_column, text_column)
    return rows.mapInArrow(lambda it: _batches(_segments(it, template), SEGMENTS), SEGMENTS)


def _read_back(batches: Iterable[pa.RecordBatch], template: Template) -> Iterator[tuple]:
    conv: object = ()
    reading = _Reading()
    for row_conv, _, _, text, loss, valid in _segments(batches, template):
        if row_conv != conv:
            if conv != ():
                yield reading.row(conv, template)
            conv, reading = row_conv, _Reading()
        reading.add(text, loss, valid, template)
    if conv != ():
        yield reading.row(conv, template)


def conversation_digests(
    conversations: DataFrame,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    template: Template | None = None,
) -> DataFrame:
    """A row a conversation, read back from its formatted text by the control strings.

    ``turns_sha256`` is over role, line end, text, line end of each turn;
    ``loss_sha256`` and ``loss_chars`` over the unescaped text under the loss flag;
    ``formatted_chars`` counts the formatted text; ``valid`` says whether all turns and
    the last one are in order. Formatting and reading happen in the same pass. Cases
    as in :func:`format_turns`.
    """
    template = template or Template()
    rows = _in_order(conversations, conv_column, turn_column, role_column, text_column)
    return rows.mapInArrow(lambda it: _batches(_read_back(it, template), DIGESTS), DIGESTS)
