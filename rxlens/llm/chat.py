r"""Chat formatting with a grammar that reads back exactly what was written.

A turn is rendered as::

    ### role:
    text
    </turn>

Control strings are ``###`` and ``</turn>``. The parser is deterministic: it reads a head, then
text up to the first control string without a backslash before it, which must be the end of the
turn. A control string after ``k > 0`` backslashes is text, with ``k - 1`` of them.

Each turn is first rendered as it is and parsed again. If the parser does not return the same
role and text, every control string in the text gets one more backslash, with those already
there, and the turn is parsed anew, until both are identical. (One round is enough for any
text; the loop is the proof.) A turn that parses to itself leaves the parser where it began, so
a conversation of such turns parses to its turns.

Turns are rendered and verified wherever their rows lie. Reading back sorts the rendered turns
by conversation and streams them through the parser, piece by piece, so that a conversation of
any length needs the memory of one turn. Digests over a whole conversation are sequential by
definition, so its pieces are read by one task.

Defined results: a null text or role is empty; turns are in order of ``turn`` (nulls first), of
equal turns by role, then text; a null ``conv_id`` is a conversation of its own; rows that
repeat are turns of their own; a role may hold any characters (backslash, colon and line break
are escaped); an empty table gives no conversations. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlens.llm.arrow import batch_of

HEAD = "###"
END = "</turn>"
LEARNED_ROLE = "assistant"
_CONTROL = re.compile(r"(\\*)(###|</turn>)")
_ROLE = re.compile(r"((?:[^\\:\n]|\\[\\:n])*):\n")
_ROLE_OUT = {"\\": "\\\\", ":": "\\:", "\n": "\\n"}
_ROLE_IN = {"\\": "\\", ":": ":", "n": "\n"}


class GrammarError(ValueError):
    """The rendered text is not in the language of the template."""


def write_role(role: str) -> str:
    return "".join(_ROLE_OUT.get(c, c) for c in role)


def read_role(written: str) -> str:
    return re.sub(r"\\(.)", lambda m: _ROLE_IN[m[1]], written)


def parse_turn(rendered: str, at: int = 0) -> tuple[str, str, int, int, int]:
    """Read one turn: role, text, where its written text starts and ends, where the turn ends."""
    head = f"{HEAD} "
    if not rendered.startswith(head, at):
        raise GrammarError(f"no turn at {at}")
    role = _ROLE.match(rendered, at + len(head))
    if role is None:
        raise GrammarError(f"no role at {at}")
    start, pieces, seen = role.end(), [], role.end()
    for control in _CONTROL.finditer(rendered, start):
        if control[1]:
            pieces.append(rendered[seen : control.start()] + control[0][1:])
            seen = control.end()
            continue
        stop = control.start()
        if control[2] != END or rendered[stop - 1] != "\n" or stop == start:
            raise GrammarError(f"unexpected {control[2]} at {stop}")
        if rendered[control.end() : control.end() + 1] != "\n":
            raise GrammarError(f"no line end after {END} at {stop}")
        pieces.append(rendered[seen : stop - 1])
        return read_role(role[1]), "".join(pieces), start, stop - 1, control.end() + 1
    raise GrammarError(f"turn at {at} does not end")


def render_turn(role: str, text: str) -> str:
    """Write one turn so that it reads back as it is."""
    written = text
    while True:
        rendered = f"{HEAD} {write_role(role)}:\n{written}\n{END}\n"
        try:
            found = parse_turn(rendered)
            if found[:2] == (role, text) and found[4] == len(rendered):
                return rendered
        except GrammarError:
            pass
        written = _CONTROL.sub(r"\\\1\2", written)


def parse(rendered: str) -> list[tuple[str, str]]:
    """The turns of a whole conversation."""
    turns, at = [], 0
    while at < len(rendered):
        role, text, _, _, at = parse_turn(rendered, at)
        turns.append((role, text))
    return turns


_RENDERED = "conv_id long, turn long, role string, text string, rendered string"


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            (conv, turn, role, text, render_turn(role, text))
            for conv, turn, role, text in zip(*(batch.column(i).to_pylist() for i in range(4)))
        ]
        yield batch_of(rows, _RENDERED)


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: ``conv_id``, ``turn``, ``role``, ``text`` and ``rendered``.

    A conversation is its rendered turns, one behind the other.
    """
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).mapInArrow(_render, _RENDERED)


_DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)


class _Conversation:
    """What is known of the conversation that is being read."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, rendered: str) -> None:
        at = 0
        while at < len(rendered):
            role, text, _, _, at = parse_turn(rendered, at)
            self.turns += 1
            for part in (role, "\n", text, "\n"):
                self.all.update(part.encode())
            if role == LEARNED_ROLE:
                self.loss_chars += len(text)
                self.loss.update(text.encode())
        self.chars += len(rendered)

    def row(self) -> tuple:
        return (
            self.conv_id,
            self.turns,
            self.all.hexdigest(),
            self.loss_chars,
            self.loss.hexdigest(),
            self.chars,
        )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conversation and turn."""
    now = None
    for batch in batches:
        done = []
        pairs = zip(batch.column("conv_id").to_pylist(), batch.column("rendered").to_pylist())
        for conv_id, rendered in pairs:
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.row())
                now = _Conversation(conv_id)
            now.read(rendered)
        yield batch_of(done, _DIGEST)
    if now is not None:
        yield batch_of([now.row()], _DIGEST)


def read_back(turns: DataFrame) -> DataFrame:
    """Per conversation, what its rendered turns say: counts and digests."""
    order = ["conv_id", "turn", "role", "text"]
    return (
        turns.select(*order, "rendered")
        .repartition("conv_id")
        .sortWithinPartitions(*order)
        .select("conv_id", "rendered")
        .mapInArrow(_read, _DIGEST)
    )


def loss_spans(rendered: str) -> list[tuple[int, int]]:
    """Where the written assistant texts lie in a rendered conversation: the loss mask."""
    spans, at = [], 0
    while at < len(rendered):
        role, _, start, stop, at = parse_turn(rendered, at)
        if role == LEARNED_ROLE:
            spans.append((start, stop))
    return spans
