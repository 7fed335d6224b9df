"""Chat formatting: a finite-state machine over roles and a declarative template.

The rows of a conversation are put in the order (turn, role, text), nulls first, by
a shuffle on conv_id and a sort inside partitions; one pass over each partition
streams them, so a conversation of any length needs no more memory than one Arrow
batch.  Each turn becomes five segments, or fewer where one is empty: opening mark, role, header
end, text, closing mark.  A segment carries its text and whether it counts for the
loss; only the text segments of the template's loss roles do.

Any ``<|`` inside a role or text gets one backslash after ``<`` (``<\\|``, and one
more for each that is there already), so a text can never form a control string and
``unescape`` restores it exactly.  Newlines in a role are escaped too.

The machine's verdict doesn't drop turns: ``valid`` is the state after each turn,
false from the first turn on that breaks the order.

Defined results: null role or text is empty; rows without a conv_id form one conversation;
repeated rows are turns of their own, and turns of equal number stand in order of role and
text; an empty text is a turn with a segment of no characters; a very long conversation is
streamed; an empty table gives no segments; extra columns are not carried.
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
    """What surrounds a turn, which roles may follow which, and what is learned."""

    open_mark: str = "<|im_start|>"
    header_end: str = "\n"
    close_mark: str = "<|im_end|>\n"
    loss_roles: frozenset = frozenset({"assistant"})
    #: state -> role -> next state; the state after the last turn must be in ``final``
    moves: dict = field(default_factory=lambda: {
        "start": {"system": "briefed", "user": "asked"},
        "briefed": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    })
    final: frozenset = frozenset({"answered"})


CHATML = Template()
_RAW = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<(\\*)\\\|")
SEGMENTS = "conv_id long, turn_no long, part string, text string, loss boolean, valid boolean, complete boolean"


def escape(text: str) -> str:
    return _RAW.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def format_conversations(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """Segments of all conversations, in order inside each partition.

    ``complete`` is set on a conversation's last segment only: whether its turns end
    in a final state without a breach."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = pa.schema([("conv_id", pa.int64()), ("turn_no", pa.int64()), ("part", pa.string()), ("text", pa.string()), ("loss", pa.bool_()), ("valid", pa.bool_()), ("complete", pa.bool_())])

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        at, no, state = (), 0, None

        def flushed():
            nonlocal out
            batch = pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out = []
            return batch

        for batch in batches:
            held = 0
            for conv, role, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if at != (conv,):
                    if out:
                        out[-1] = out[-1][:6] + (state in template.final,)
                    at, no, state = (conv,), 0, "start"
                state = template.moves.get(state, {}).get(role, "broken")
                ok = state != "broken"
                for part, piece in (("open", template.open_mark), ("role", escape_role(role)), ("header", template.header_end), ("text", escape(text)), ("close", template.close_mark)):
                    if piece or part == "text":
                        out.append((conv, no, part, piece, part == "text" and role in template.loss_roles, ok, None))
                no += 1
                held += len(text)
                if held > 4_000_000 and len(out) > 1:
                    last = out.pop()
                    yield flushed()
                    out, held = [last], 0
            if len(out) > 1:  # the last segment waits for what comes next
                last = out.pop()
                yield flushed()
                out = [last]
        if out:
            out[-1] = out[-1][:6] + (state in template.final,)
            yield flushed()

    return rows.mapInArrow(segments, SEGMENTS)


def read_back(segments: DataFrame) -> DataFrame:
    """One row per conversation, read from its segments alone: number and digest of
    the turns, characters and digest under the loss mask, formatted characters, and
    the machine's verdict.  Needs the order ``format_conversations`` gives; digests
    are updated piece by piece."""
    names = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_())])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now = None

        def row():
            return (now["conv"], now["turns"], now["all"].hexdigest(), now["chars"], now["loss"].hexdigest(), now["total"], now["valid"])

        for batch in batches:
            for conv, part, text, loss, complete in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 6)), strict=True):
                if now is None:
                    now = {"conv": conv, "turns": 0, "all": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "total": 0, "valid": False, "role": ""}
                now["total"] += len(text)
                if part == "open":
                    now["role"] = ""
                elif part == "role":
                    now["role"] = unescape_role(text)
                elif part == "text":
                    plain = unescape(text)
                    now["turns"] += 1
                    now["all"].update(f"{now['role']}\n{plain}\n".encode("utf-8", "surrogatepass"))
                    if loss:
                        now["chars"] += len(plain)
                        now["loss"].update(plain.encode("utf-8", "surrogatepass"))
                if complete is not None:  # a conversation's last segment
                    now["valid"] = complete
                    done.append(row())
                    now = None
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)
                done = []

    return segments.mapInArrow(digests, names)


def training_texts(segments: DataFrame) -> DataFrame:
    """conv_id, formatted text and the character spans under the loss mask, in the order
    ``format_conversations`` gives.  A conversation is one row, which its consumer needs
    anyway."""
    names = "conv_id long, text string, loss_spans array<struct<start: int, end: int>>"

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, spans, at = [], [], 0
        for batch in batches:
            for conv, text, loss, complete in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4, 6)), strict=True):
                pieces.append(text)
                if loss:
                    spans.append({"start": at, "end": at + len(text)})
                at += len(text)
                if complete is not None:  # a conversation's last segment
                    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                    yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array(["".join(pieces)]), pa.array([spans], kind)], names=["conv_id", "text", "loss_spans"])
                    pieces, spans, at = [], [], 0

    return segments.mapInArrow(joined, names)
