"""Conversations as training text with a loss flag on each segment.

A finite-state machine walks over the roles of a conversation: each turn has to follow one that
the template allows before it. A turn gives three segments, its mark, its text and its end mark;
only texts of roles under training have the loss flag. A conversation is ordered by turn, then
role and text (ties), and passes through one task as a stream, so memory does not grow with its
length.

Null texts and roles are empty. Unknown roles and turns out of order are formatted, with
valid = false on them. Repeated rows are turns of their own. An empty table gives no rows.
Further columns are dropped.
"""

import hashlib
import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START = ""


@dataclass(frozen=True)
class Template:
    """Marks around a turn; `follows` names the roles after which a role may speak."""

    opening: str = "<turn:{role}>\n"
    closing: str = "</turn>\n"
    trained: frozenset = frozenset({"assistant"})
    follows: dict = field(
        default_factory=lambda: {
            "system": {START},
            "user": {START, "system", "assistant"},
            "assistant": {"user"},
        }
    )


DEFAULT = Template()
FORMATTED = "conv_id long, turn long, valid boolean, segments array<struct<text:string,loss:boolean>>"
READ_BACK = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, valid boolean"
)
_CONTROL = re.compile(r"[\\<>]")
_ESCAPED = re.compile(r"\\([\\<>])")


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_conversations(conversations: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per turn with its segments; the turns of a conversation are adjacent and in order."""

    def walk(frames):
        conversation, state = object(), START
        for frame in frames:
            out = []
            for conv, turn, role, text in frame.itertuples(index=False):
                if conv != conversation:
                    conversation, state = conv, START
                valid = state in template.follows.get(role, ())
                state = role
                mark = template.opening.format(role=escape(role))
                out.append(
                    (conv, turn, valid, [(mark, False), (escape(text), role in template.trained), (template.closing, False)])
                )
            segments = [[{"text": t, "loss": m} for t, m in row[3]] for row in out]
            yield pd.DataFrame(
                {
                    "conv_id": pd.array([row[0] for row in out], dtype="Int64"),
                    "turn": pd.array([row[1] for row in out], dtype="Int64"),
                    "valid": [row[2] for row in out],
                    "segments": segments,
                }
            )

    # ids travel as text, since a null id would turn its column into floats
    ordered = (
        conversations.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .withColumn("conv_id", F.col("conv_id").cast("string"))
        .withColumn("turn", F.col("turn").cast("string"))
    )
    return ordered.mapInPandas(lambda frames: walk(map(_with_ids, frames)), FORMATTED)


def _with_ids(frame):
    for name in ("conv_id", "turn"):
        frame[name] = [None if value is None else int(value) for value in frame[name]]
        frame[name] = frame[name].astype(object).where(frame[name].notna(), None)
    return frame


class _Reader:
    """Digests of the conversation that is being read."""

    def __init__(self, conv):
        self.conv, self.turns, self.chars, self.loss_chars, self.valid = conv, 0, 0, 0, True
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def row(self):
        return (
            self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.valid,
        )


def read_conversations(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Digests per conversation, parsed from the formatted text alone.

    Takes the rows as format_conversations gives them. Raises ValueError for a turn whose text
    the template could not have made.
    """
    before, after = template.opening.split("{role}")
    inner = r"((?:[^\\<>]|\\[\\<>])*)"
    turn = re.compile(re.escape(before) + inner + re.escape(after) + inner + re.escape(template.closing))

    def read(frames):
        reader = None
        for frame in frames:
            done = []
            for conv, valid, segments in zip(frame["conv_id"], frame["valid"], frame["segments"]):
                if reader is None or conv != reader.conv:
                    if reader is not None:
                        done.append(reader.row())
                    reader = _Reader(conv)
                whole = "".join(s["text"] for s in segments)
                found = turn.fullmatch(whole)
                if not found:
                    raise ValueError(f"conversation {conv}: not a turn of this template")
                role, text = map(unescape, found.groups())
                reader.turns += 1
                reader.chars += len(whole)
                reader.valid &= bool(valid)
                reader.all.update(f"{role}\n{text}\n".encode())
                learned = unescape("".join(s["text"] for s in segments if s["loss"]))
                reader.loss.update(learned.encode())
                reader.loss_chars += len(learned)
            yield _digests(done)
        if reader is not None:
            yield _digests([reader.row()])

    narrow = formatted.select(F.col("conv_id").cast("string").alias("conv_id"), "valid", "segments")
    return narrow.mapInPandas(read, READ_BACK)


def _digests(done):
    names = [part.split()[0] for part in READ_BACK.split(", ")]
    frame = pd.DataFrame(done, columns=names)
    frame["conv_id"] = pd.array([None if c is None else int(c) for c in frame["conv_id"]], dtype="Int64")
    return frame
