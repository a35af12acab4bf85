"""Chat formatting of typed content parts.

A turn's content is a list of parts: text, image, audio or document. A visitor flattens the parts into
text, with a placeholder for each attachment, numbered through the conversation, and records what the
placeholder refers to and how many tokens it stands for. The formatted conversation marks every turn:

    <turn user>first text</turn>
    <turn assistant>second text <image 0></turn>

All control strings begin with ``<``. In texts, references and roles, ``<``, ``>`` and the backslash get a
backslash before them, so no text can hold a control string, and taking the backslashes off gives back every text.

A conversation is formatted and read turn by turn in order, as a stream of segments; neither a task nor a
cell ever holds a whole conversation. Digests are by nature made in one pass, so one conversation is read
by one task, however long it is.

Defined results: a null text or null content is one empty text part, a null role an empty role. Rows with a
null conv_id are one conversation. Turns come in order of turn, role and text, nulls first; rows that repeat stay.
An empty table gives no rows. Other columns are not looked at. An unknown kind of part is refused.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordbase.llm.common import arrow_rows

PARTS = "array<struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>>"
ATTACHMENTS = "array<struct<number: long, kind: string, ref: string, at: long, tokens: long>>"
SEGMENT = (
    "conv_id long, turn long, role string, segment string, loss_from long, loss_to long,"
    f" attachments {ATTACHMENTS}, expanded_tokens long"
)
LOSS_ROLE = "assistant"

# Token counts of attachments: images by tiles, audio by frames, documents by pages.
TILE, TILE_TOKENS, IMAGE_TOKENS = 512, 170, 85
AUDIO_TOKENS_A_SECOND = 25
PAGE_TOKENS = 256

_ESCAPED = re.compile(r"[\\<>]")
_UNESCAPED = re.compile(r"\\(.)", re.S)
_CONTROL = re.compile(r"(?:[^\\<]++|\\.)*+(<(?:[^\\>]++|\\.)*+>)", re.S)


def escape(text: str) -> str:
    return _ESCAPED.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _UNESCAPED.sub(r"\1", text)


class PartVisitor:
    """Flattens the parts of one conversation; attachments are numbered in order."""

    def __init__(self) -> None:
        self.number = 0
        self.new_turn()

    def new_turn(self) -> None:
        self.out: list[str] = []
        self.length = 0
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        kind = part.get("kind")
        if kind not in ("text", "image", "audio", "document"):
            raise ValueError(f"unknown kind of part: {kind}")
        getattr(self, f"visit_{kind}")(part)

    def visit_text(self, part: dict) -> None:
        self._put(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        tiles = -(-(part.get("width") or 1) // TILE) * -(-(part.get("height") or 1) // TILE)
        self._attach(part, IMAGE_TOKENS + TILE_TOKENS * tiles)

    def visit_audio(self, part: dict) -> None:
        self._attach(part, int(-(-(part.get("seconds") or 0) * AUDIO_TOKENS_A_SECOND // 1)))

    def visit_document(self, part: dict) -> None:
        self._attach(part, PAGE_TOKENS * (part.get("pages") or 1))

    def _attach(self, part: dict, tokens: int) -> None:
        self.attachments.append(
            {"number": self.number, "kind": part["kind"], "ref": part.get("ref"), "at": self.length, "tokens": tokens}
        )
        self._put(f"<{part['kind']} {self.number}>")
        self.number += 1

    def _put(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)


def text_part(text: Column) -> Column:
    """Content of one text part, for tables that hold plain texts."""
    part = F.struct(
        F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
    )
    return F.array(part).cast(PARTS)


def format_conversations(turns: DataFrame) -> DataFrame:
    """Segments of the formatted conversations, one a turn, in order within each partition.

    ``turns`` has conv_id, turn, role and ``parts`` (see ``PARTS``). The segments of a conversation, joined, are its formatted
    text. ``loss_from`` and ``loss_to`` bound the text of an assistant within its segment, ``at`` the place
    of an attachment within the text of its turn.
    """
    ordered = (
        turns.select(turns["conv_id"].cast("long").alias("conv_id"), turns["turn"].cast("long").alias("turn"), turns["role"], turns["parts"])
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "parts")
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, visitor = (), PartVisitor()
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if now != (row["conv_id"],):
                    now, visitor = (row["conv_id"],), PartVisitor()
                visitor.new_turn()
                for part in row["parts"] or ():
                    visitor.visit(part or {"kind": "text"})
                role = row["role"] or ""
                head, text = f"<turn {escape(role)}>", "".join(visitor.out)
                learned = len(text) if role == LOSS_ROLE else 0
                tokens = sum(a["tokens"] for a in visitor.attachments)
                out.append(
                    {
                        "conv_id": row["conv_id"], "turn": row["turn"], "role": role, "segment": f"{head}{text}</turn>\n",
                        "loss_from": len(head), "loss_to": len(head) + learned, "attachments": visitor.attachments, "expanded_tokens": tokens,
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema(
        [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("segment", pa.string()), ("loss_from", pa.int64()), ("loss_to", pa.int64()),
         ("attachments", pa.list_(pa.struct([("number", pa.int64()), ("kind", pa.string()), ("ref", pa.string()), ("at", pa.int64()), ("tokens", pa.int64())]))),
         ("expanded_tokens", pa.int64())]
    )
    return arrow_rows(ordered, rows, SEGMENT)


def read_turns(segments: Iterator[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation, whose text may be cut into segments anywhere."""
    rest, role, text = "", None, []
    for segment in segments:
        rest += segment
        at = 0
        while found := _CONTROL.match(rest, at):
            control = found[1]
            text.append(rest[at : found.start(1)])
            if control == "</turn>":
                yield role or "", unescape("".join(text))
                role, text = None, []
            elif control.startswith("<turn ") and role is None:
                role, text = unescape(control[6:-1]), []
            else:
                text.append(control)
            at = found.end()
        rest = rest[at:]


def conversation_digests(segments: DataFrame) -> DataFrame:
    """What the formatted conversations say when they are read back, a row each.

    ``segments`` comes straight from ``format_conversations``, whose order within partitions it relies on.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = (), None
        for batch in batches:
            out = []
            columns = (batch[c].to_pylist() for c in ("conv_id", "segment", "loss_from", "loss_to", "attachments", "expanded_tokens"))
            for conv, segment, begin, end, attachments, tokens in zip(*columns, strict=True):
                if now != (conv,):
                    out += [state] if state else []
                    now, state = (conv,), [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                for role, text in read_turns(iter([segment])):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                learned = unescape(segment[begin:end])
                state[3] += len(learned)
                state[4].update(learned.encode())
                state[5] += len(segment)
                state[6] += len(attachments)
                state[7] += tokens
            yield batch_of(out)
        yield batch_of([state] if state else [])

    def batch_of(states: list) -> pa.RecordBatch:
        rows = [[x.hexdigest() if hasattr(x, "hexdigest") else x for x in s] for s in states]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_attachments", "expanded_tokens"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 3]
    schema = ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in zip(names, types, strict=True))
    return arrow_rows(segments, rows, schema)
