"""Chat formatting: roles checked by a state machine, text segments with loss flags.

A template is data: for each role the text before and after a turn, which turns are trained
on, which role may follow which, and the escape character.  Formatting a conversation is one
pass over its turns in order that keeps only the last role, so a conversation of any length
takes constant memory.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START = ""  # the state before the first turn


@dataclass(frozen=True)
class Template:
    """``follows``: the roles that may come after each state.  ``controls``: strings that mark
    turns and must not be read in a text; there the escape character is put behind their first
    character, and texts' own escape characters are doubled."""

    before: dict[str, str] = field(default_factory=lambda: {
        "system": "<s>[INST] <<SYS>>\n", "user": "<s>[INST] ", "assistant": ""})
    after: dict[str, str] = field(default_factory=lambda: {
        "system": "\n<</SYS>> [/INST]</s>", "user": " [/INST]", "assistant": "</s>"})
    trained: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        START: ("system", "user"), "system": ("user",), "user": ("assistant",),
        "assistant": ("user",)})
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    escape: str = "\\"

    def escaped(self, text: str) -> str:
        text = text.replace(self.escape, self.escape * 2)
        starts = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in self.controls)
        return re.sub(starts, lambda m: m[0] + self.escape, text)

    def unescaped(self, text: str) -> str:
        mark = re.escape(self.escape)
        return re.sub(f"{mark}({mark}?)", r"\1", text)

    def opening(self, role: str) -> str:
        """What stands before a turn; an unknown role is named, its control strings escaped."""
        return self.before.get(role, f"<s>[INST] <<SYS>>{self.escaped(role)}\n")

    def closing(self, role: str) -> str:
        return self.after.get(role, "\n<</SYS>> [/INST]</s>")


_SEGMENTS = pa.schema([
    ("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("kind", pa.string()),
    ("text", pa.string()), ("loss", pa.bool_()), ("valid", pa.bool_()),
])


def format_chats(chats: DataFrame, template: Template = Template()) -> DataFrame:
    """Segments of the formatted conversations in ``chats`` (conv_id, turn, role, text).

    A row for each segment: conv_id, position (from 0 in each conversation), role, kind
    ("open", "text" or "close"), text (escaped if of kind "text"), loss (whether it is trained on:
    the texts of trained roles) and valid (whether the state machine allowed the turns up to
    here).  Turns are ordered by turn, then role and text; null and repeated turn numbers
    are kept in that order, nulls first.  A null text or role is empty, and an empty or unknown
    role isn't allowed by the state machine but formatted all the same.  Rows of a
    null conv_id are one conversation.  The segments of a conversation stay together and in
    order in one partition; its turns pass through one at a time, never collected.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, position, valid = object(), START, 0, True
        for batch in batches:
            rows = []
            for conv_id, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if conv_id != current:
                    current, state, position, valid = conv_id, START, 0, True
                valid = valid and role in template.follows.get(state, ())
                state = role
                for kind, piece in (("open", template.opening(role)),
                                    ("text", template.escaped(text)),
                                    ("close", template.closing(role))):
                    loss = kind == "text" and role in template.trained
                    rows.append((conv_id, position, role, kind, piece, loss, valid))
                    position += 1
            columns = zip(*rows) if rows else ([] for _ in _SEGMENTS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(columns, _SEGMENTS)], schema=_SEGMENTS)

    turns = (
        chats.select(F.col("conv_id").cast("long").alias("conv_id"),
                     F.col("turn").cast("long").alias("turn"),
                     F.coalesce("role", F.lit("")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )
    return turns.mapInArrow(
        run, "conv_id LONG, position LONG, role STRING, kind STRING, text STRING, loss BOOLEAN,"
             " valid BOOLEAN")


def read_back(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """Digests of each conversation, from segments as ``format_chats`` returns them.

    Columns: conv_id, n_turns, turns_sha256 (role and unescaped text of each turn, a line end
    after each), loss_chars and loss_sha256 (of all unescaped text under the loss mask),
    formatted_chars, valid.  Digests are fed a segment at a time.
    """
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                 "formatted_chars", "valid"]
        current, began = None, False

        def new():
            return {"turns": hashlib.sha256(), "loss": hashlib.sha256(), "n": 0, "chars": 0,
                    "formatted": 0, "valid": True}

        def row():
            return (current, sums["n"], sums["turns"].hexdigest(), sums["chars"],
                    sums["loss"].hexdigest(), sums["formatted"], sums["valid"])

        sums = new()
        for batch in batches:
            done = []
            for conv_id, role, kind, text, loss, valid in zip(*(c.to_pylist() for c in batch.columns)):
                if began and conv_id != current:
                    done.append(row())
                    sums = new()
                current, began = conv_id, True
                sums["formatted"] += len(text)
                sums["valid"] = valid
                plain = template.unescaped(text) if kind == "text" else ""
                if kind == "text":
                    sums["n"] += 1
                    sums["turns"].update(f"{role}\n{plain}\n".encode())
                if loss:
                    sums["chars"] += len(plain)
                    sums["loss"].update(plain.encode())
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in done], _DIGESTS)
        if began:
            yield pa.RecordBatch.from_pylist([dict(zip(names, row()))], _DIGESTS)

    return segments.select("conv_id", "role", "kind", "text", "loss", "valid").mapInArrow(
        run, "conv_id LONG, n_turns LONG, turns_sha256 STRING, loss_chars LONG, loss_sha256 STRING,"
             " formatted_chars LONG, valid BOOLEAN")


_DIGESTS = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ("valid", pa.bool_()),
])
