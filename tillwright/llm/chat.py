"""Chat formatting: a finite-state machine over roles and a declarative template.

States are the role of the turn before (none at the start). The template says
which roles may follow which state, how a role's turn opens and closes, and
whether its text is learned. A turn that may not follow is marked ``valid =
false`` and formatted all the same; the machine goes on from its role.

Control strings inside texts are broken by a backslash after their first
character, and backslashes are doubled, so that texts come back unchanged.

Rows are taken by turn; rows that tie in turn are ordered by role and text, and
repeated rows are turns of their own. A null text is empty, a null role the
empty role, a null turn comes first, and null conv_ids form one conversation. A
conversation is streamed through one task in order, as its digests need; no
task holds more of it than an Arrow batch.
"""

from __future__ import annotations

import dataclasses
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclasses.dataclass(frozen=True)
class Turn:
    open: str
    close: str
    learned: bool = False


@dataclasses.dataclass(frozen=True)
class Template:
    """``named`` opens the turns of roles that have no form of their own; the escaped role follows and ``between`` ends it."""

    turns: dict[str, Turn]
    follows: dict[str | None, frozenset[str]]
    ends: frozenset[str]
    named: str
    between: str
    close: str

    def controls(self) -> list[str]:
        marks = {m.strip() for t in self.turns.values() for m in (t.open, t.close)}
        return sorted({m for m in marks | {self.named, self.between, self.close} if m}, key=len, reverse=True)


INSTRUCT = Template(
    turns={
        "system": Turn("<<SYS>>\n", "\n<</SYS>>\n\n"),
        "user": Turn("[INST] ", " [/INST]"),
        "assistant": Turn("<s>", "</s>\n", learned=True),
    },
    follows={
        None: frozenset({"system", "user"}),
        "system": frozenset({"user"}),
        "user": frozenset({"assistant"}),
        "assistant": frozenset({"user"}),
    },
    ends=frozenset({"assistant"}),
    named="[ROLE]", between="[/ROLE]", close="[/TURN]",
)


class Writer:
    """Escapes texts and lays out turns by a template."""

    def __init__(self, template: Template):
        self.template = template
        self.special = re.compile("|".join([r"\\", *map(re.escape, template.controls())]))

    def escape(self, text: str) -> str:
        return self.special.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def segments(self, role: str, text: str) -> list[dict]:
        """The turn as pieces with loss flags; only a learned role's text has one."""
        form, t = self.template.turns.get(role), self.template
        if form is None:
            form = Turn(f"{t.named}{self.escape(role)}{t.between}", t.close)
        return [{"text": form.open, "loss": False}, {"text": self.escape(text), "loss": form.learned}, {"text": form.close, "loss": False}]

    def read_turn(self, written: str, start: int = 0) -> tuple[str, str, int]:
        """Role and text of the turn that begins at ``start``, and where it ends."""
        t = self.template
        for role, form in t.turns.items():
            if written.startswith(form.open, start):
                begin, close = start + len(form.open), form.close
                break
        else:
            if not written.startswith(t.named, start):
                raise ValueError("no turn begins here")
            end = written.index(t.between, start)
            role, begin, close = self.unescape(written[start + len(t.named):end]), end + len(t.between), t.close
        end = written.index(close, begin)
        return role, self.unescape(written[begin:end]), end + len(close)

    def read(self, written: str) -> list[tuple[str, str]]:
        """The turns of a whole formatted conversation."""
        at, turns = 0, []
        while at < len(written):
            role, text, at = self.read_turn(written, at)
            turns.append((role, text))
        return turns


SEGMENTS = "array<struct<text: string, loss: boolean>>"


def format_turns(rows: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per turn in order: conv_id, position from 0, role, segments with loss flags, valid, complete.

    ``complete`` is set on a turn after which the conversation may end.
    """
    ordered = (
        rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    )
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, state, conversation, position = Writer(template), None, object(), 0
        for batch in batches:
            out = {k: [] for k in ("position", "segments", "valid", "complete")}
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv != conversation:
                    conversation, state, position = conv, None, 0
                out["position"].append(position)
                out["segments"].append(writer.segments(role, text))
                out["valid"].append(role in template.follows.get(state, ()))
                out["complete"].append(role in template.ends)
                state, position = role, position + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(out["position"], pa.int64()), batch.column("role"),
                 pa.array(out["segments"], pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))),
                 pa.array(out["valid"], pa.bool_()), pa.array(out["complete"], pa.bool_())],
                ["conv_id", "position", "role", "segments", "valid", "complete"])

    return ordered.mapInArrow(run, f"conv_id {kind}, position long, role string, segments {SEGMENTS}, valid boolean, complete boolean")


def digests(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per conversation, read back from the segments of ``format_turns`` as they stream by.

    It must follow ``format_turns`` directly: it relies on its order.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, open_, conversation, key = Writer(template), False, None, None

        def fresh() -> dict:
            return {"n": 0, "turns": hashlib.sha256(), "loss_chars": 0, "loss": hashlib.sha256(), "chars": 0, "valid": True, "complete": False}

        def closed(state: dict) -> list:
            return [state["n"], state["turns"].hexdigest(), state["loss_chars"], state["loss"].hexdigest(), state["chars"],
                    state["valid"] and state["complete"]]

        state = fresh()
        for batch in batches:
            keys, done = [], []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "segments", "valid", "complete"))
            for conv, segments, valid, complete in zip(*columns):
                if open_ and conv != conversation:
                    keys.append(conversation)
                    done.append(closed(state))
                    state = fresh()
                open_, conversation = True, conv
                written = "".join(s["text"] for s in segments)
                role, text, _ = writer.read_turn(written)
                learned = "".join(writer.unescape(s["text"]) for s in segments if s["loss"])
                state["n"] += 1
                state["turns"].update(f"{role}\n{text}\n".encode())
                state["loss_chars"] += len(learned)
                state["loss"].update(learned.encode())
                state["chars"] += len(written)
                state["valid"] &= valid
                state["complete"] = complete
            key = batch.schema.field("conv_id").type
            if done:
                yield rows_of(keys, key, done)
        if open_:
            yield rows_of([conversation], key, [closed(state)])

    def rows_of(keys: list, kind: pa.DataType, done: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, kind), *(pa.array(c, t) for c, t in zip(zip(*done), types))], ["conv_id", *names])

    return turns.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                 "formatted_chars long, valid boolean")
