"""Chat formatting: a declarative template, a finite-state machine over roles, text segments with loss flags, and the way back.

Every turn becomes three segments: what opens it, its text, what closes it. The loss flag is set on the texts of the roles
that the template names. Control strings inside texts are broken by a backslash after their first character, and backslashes
are doubled, so that no text can end a turn and everything can be read back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """How turns are written. A turn of a role without an entry is written as `other`, with its role spelled out."""

    turns: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "system": ("<<SYS>>\n", "\n<</SYS>>\n\n"), "user": ("[INST] ", " [/INST]"), "assistant": (" ", " </s>")})
    other: tuple[str, str, str] = ("<|role|>", "<|text|>", "<|end|>")
    control: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|role|>", "<|text|>", "<|end|>")
    loss: frozenset[str] = frozenset({"assistant"})
    #: What may follow what; "" is the start, and a conversation may end in the states of `final`.
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple[str, ...] = ("assistant",)

    def escape(self, text: str) -> str:
        return re.sub("|".join([r"\\", *map(re.escape, self.control)]), lambda m: m[0][0] + "\\" + m[0][1:], text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def segments(self, role: str, text: str) -> tuple[str, str, str]:
        if role in self.turns:
            before, after = self.turns[role]
        else:
            before, after = f"{self.other[0]}{self.escape(role)}{self.other[1]}", self.other[2]
        return before, self.escape(text), after

    def read(self, formatted: str, at: int) -> tuple[str, str, int, int, int] | None:
        """The turn that begins at a place: role, text, where its text begins and ends, where the turn ends. None if it isn't whole."""
        if formatted.startswith(self.other[0], at):
            middle = formatted.find(self.other[1], at)
            end = formatted.find(self.other[2], middle)
            if middle < 0 or end < 0:
                return None
            start = middle + len(self.other[1])
            return self.unescape(formatted[at + len(self.other[0]):middle]), self.unescape(formatted[start:end]), start, end, end + len(self.other[2])
        for role, (before, after) in self.turns.items():
            if formatted.startswith(before, at):
                start = at + len(before)
                end = formatted.find(after, start)
                return None if end < 0 else (role, self.unescape(formatted[start:end]), start, end, end + len(after))
        return None


def ordered(conversations: DataFrame) -> DataFrame:
    """Whole conversations together, turns in order; equal turns by role and text. Nulls come first; null role and text are empty."""
    rows = conversations.select("conv_id", "turn", *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, dict]]:
    """Rows one by one, each with whether it begins a conversation."""
    started, conv = False, None
    for batch in batches:
        for row in batch.to_pylist():
            yield not started or row["conv_id"] != conv, row
            started, conv = True, row["conv_id"]


def _batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], size: int = 2000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


def formatted(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, segment (from 0), role, text, loss, problem of conversations(conv_id, turn, role, text).

    problem, on the segment that opens a turn, says why the turn may not follow the one before it; null if it may. All turns
    are written all the same. Rows stream through, so memory holds a turn and not a conversation. Rows without conv_id make
    up one conversation; repeated rows are turns of their own; an empty table gives no segments; other columns are not read.
    """
    names = ["conv_id", "segment", "role", "text", "loss", "problem"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.string()]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            state, number = "", 0
            for first, row in _runs(batches):
                if first:
                    state, number = "", 0
                role = row["role"]
                problem = None if role in template.follows.get(state, ()) else f"{role or 'no role'} after {state or 'the start'}"
                for k, text in enumerate(template.segments(role, row["text"])):
                    yield row["conv_id"], number + k, role, text, k == 1 and role in template.loss, problem if k == 0 else None
                state, number = role, number + 3

        yield from _batches(rows(), names, kinds)

    plain = ordered(conversations.withColumn("conv_id", F.col("conv_id").cast("long")))
    return plain.mapInArrow(write, "conv_id long, segment long, role string, text string, loss boolean, problem string")


def read_back(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation, from its segments: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_problems, complete.

    Roles and texts are parsed out of the joined text; the loss digest covers what lies under the loss flags. complete is
    whether the conversation ends where the template says it may.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_problems", "complete"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]

    class Reader:
        def __init__(self, conv_id):
            self.conv_id, self.turns, self.loss_chars, self.chars, self.problems, self.role = conv_id, 0, 0, 0, 0, ""
            self.all, self.loss = hashlib.sha256(), hashlib.sha256()
            self.buffer, self.flags = "", []      # a turn's text so far, and the parts of it under the loss flag

        def add(self, text: str, loss: bool, problem: str | None) -> None:
            if loss:
                self.flags.append((len(self.buffer), len(self.buffer) + len(text)))
            self.buffer += text
            self.chars += len(text)
            self.problems += problem is not None
            turn = template.read(self.buffer, 0)
            if turn and turn[4] == len(self.buffer):
                role, said = turn[:2]
                self.all.update(f"{role}\n{said}\n".encode())
                for start, end in self.flags:
                    under = template.unescape(self.buffer[start:end])
                    self.loss.update(under.encode())
                    self.loss_chars += len(under)
                self.turns, self.role = self.turns + 1, role
                self.buffer, self.flags = "", []

        def row(self) -> tuple:
            if self.buffer:
                raise ValueError(f"conversation {self.conv_id} ends within a turn")
            return (self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.problems, self.role in template.final)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            reader = None
            for first, row in _runs(batches):
                if first:
                    if reader:
                        yield reader.row()
                    reader = Reader(row["conv_id"])
                reader.add(row["text"], row["loss"], row["problem"])
            if reader:
                yield reader.row()

        yield from _batches(rows(), names, kinds)

    together = segments.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return together.select("conv_id", "text", "loss", "problem").mapInArrow(
        parse, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_problems long, complete boolean")
