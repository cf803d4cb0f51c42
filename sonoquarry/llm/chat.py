"""Chat formatting: a finite-state machine over roles, and a declarative template of turns.

A template names for each role the header that opens its turn, the string that ends a turn, which
roles carry loss, and the moves between roles. A turn becomes three segments: header, text, end; only
the text of a learnt role carries loss. Control strings inside a text get an escape character before
them, and so does the escape character itself, so that a formatted conversation is read back exactly.

Conversations are dealt by id and sorted by turn; each task then streams over its rows and keeps one
turn and two running digests, so a conversation of any length needs no more memory than its longest
turn. (A digest of a conversation is one sequence: its turns must pass through one task in order.)

Defined results: null text and null role are empty; a role without a header of its own gets a general
header with its name; rows of one conversation sort by turn, then role, then text, nulls first; rows
with null conv_id form one conversation; repeated rows are turns of their own; a conversation that
breaks the order of roles is formatted all the same and has valid = false. Other columns are not read.
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
    headers: dict[str, str] = field(default_factory=lambda: {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "})
    other: tuple[str, str] = ("### Role ", ": ")  # around the name of any other role
    end: str = "</turn>\n"
    controls: tuple[str, ...] = ("###", "</turn>")  # what no text may hold bare; each header and end starts with one
    escape: str = "\\"
    learnt: frozenset[str] = frozenset({"assistant"})
    moves: dict[str, frozenset[str]] = field(default_factory=lambda: {"": frozenset({"system", "user"}), "system": frozenset({"user"}), "user": frozenset({"assistant"}), "assistant": frozenset({"user"})})
    finals: frozenset[str] = frozenset({"assistant"})

    def escaped(self, text: str) -> str:
        text = text.replace(self.escape, self.escape * 2)
        for c in self.controls:
            text = text.replace(c, self.escape + c)
        return text

    def unescaped(self, text: str) -> str:
        return re.sub(re.escape(self.escape) + "(.)", r"\1", text, flags=re.S)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The segments of one turn, each with its loss flag."""
        head = self.headers.get(role)
        if head is None:
            # The name may not hold what ends it, nor pass for the name of a known role's header.
            name = self.escaped(role).replace(self.other[1], self.escape + self.other[1])
            head = self.other[0] + name + self.other[1]
        return [(head, False), (self.escaped(text), role in self.learnt), (self.end, False)]


class Reader:
    """Reads formatted text back into turns; the loss mask is given as the flag of each piece."""

    def __init__(self, template: Template) -> None:
        self.t = template
        e = re.escape(template.escape)
        known = "|".join(re.escape(h) for h in template.headers.values())
        name = f"(?P<name>(?:{e}.|(?!{re.escape(template.other[1])})[^{e}])*)"
        body = f"(?P<body>(?:{e}.|(?!{re.escape(template.end.rstrip())})[^{e}])*)"
        self.turn = re.compile(f"(?:(?P<known>{known})|{re.escape(template.other[0])}{name}{re.escape(template.other[1])}){body}{re.escape(template.end)}", re.S)
        self.roles = {h: r for r, h in template.headers.items()}

    def read(self, formatted: str) -> Iterator[tuple[str, str]]:
        at = 0
        while at < len(formatted):
            m = self.turn.match(formatted, at)
            if m is None:
                raise ValueError(f"no turn at {at}")
            role = self.roles[m["known"]] if m["known"] is not None else self.t.unescaped(m["name"])
            yield role, self.t.unescaped(m["body"])
            at = m.end()


class _Conversation:
    def __init__(self, conv_id: int | None, template: Template, reader: Reader) -> None:
        self.id, self.t, self.reader = conv_id, template, reader
        self.n = self.loss = self.chars = 0
        self.turns, self.learnt = hashlib.sha256(), hashlib.sha256()
        self.state, self.error = "", None

    def add(self, turn: int | None, role: str, text: str) -> None:
        if self.error is None and role not in self.t.moves.get(self.state, ()):
            self.error = f"turn {turn}: {role} after {self.state or 'start'}"
        self.state = role
        parts = self.t.segments(role, text)
        self.chars += sum(len(x) for x, _ in parts)
        for r, x in self.reader.read("".join(x for x, _ in parts)):
            self.turns.update(f"{r}\n{x}\n".encode("utf-8", "surrogatepass"))
            self.n += 1
        for x, flag in parts:
            if flag:
                plain = self.t.unescaped(x)
                self.loss += len(plain)
                self.learnt.update(plain.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        error = self.error or (None if self.state in self.t.finals else f"ends with {self.state}")
        return self.id, self.n, self.turns.hexdigest(), self.loss, self.learnt.hexdigest(), self.chars, error is None, error


def _sorted(turns: DataFrame) -> DataFrame:
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            yield from zip(*(c.to_pylist() for c in batch.slice(a, 256).columns), strict=True)


def segments(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """conv_id, turn, part (0 header, 1 text, 2 end), segment and loss; needs no shuffle."""
    template = template or Template()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(c, t, k, *s) for c, t, r, x in _rows(iter([batch])) for k, s in enumerate(template.segments(r, x))]
            columns = list(zip(*found, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_()), strict=True)], names=["conv_id", "turn", "part", "segment", "loss"])

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "conv_id long, turn long, part int, segment string, loss boolean")


def conversations(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """Format every conversation and read it back: digests, lengths and the verdict on its order of roles."""
    template = template or Template()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid", "error"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, now, done = Reader(template), None, []

        def out() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [[]] * len(names)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names=names)

        for conv_id, turn, role, text in _rows(batches):
            if now is None or now.id != conv_id:
                if now is not None:
                    done.append(now.row())
                    if len(done) >= 4096:
                        yield out()
                now = _Conversation(conv_id, template, reader)
            now.add(turn, role, text)
        if now is not None:
            done.append(now.row())
        yield out()

    return _sorted(turns).mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean, error string")
