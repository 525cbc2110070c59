"""Conversations as marked text, with typed content parts flattened by a visitor.

A turn becomes ``### role: text</turn>`` and a line feed. Control strings inside roles and texts are
escaped with a backslash, so whatever a text says, its turn can be read back. A turn may hold typed parts
(text, image, audio, document) in place of one text: a visitor flattens them in order, text parts escaped,
the others as placeholders ``<|image:3|>`` that number the attachments of the conversation; each attachment
is recorded with its reference, its place in the formatted text and the tokens it expands to.

The result has a row per turn, so that no conversation has to fit into one value: its formatted text is the
segments in the order of ``position``, ``start`` says where each begins, and ``loss_start``/``loss_end`` are
the span of the segment that the loss covers (the text of a turn of a role that is trained, without marks).
Segments of a conversation are made from one sorted stream; what a task holds is a batch, however long the
conversation is.

Order: by ``turn`` (null first), equal turns by role, text. A null role or text is an empty one. Equal rows
are turns of their own; rows with a null id are one conversation of their own. Columns that are not named
are not read, and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from claimlens.llm.common import prepared

# Control strings: the escape itself, a turn's head, its end, and the opening of a placeholder.
CONTROL = r"\\|### |</turn>|<\|"
HEAD, END, AFTER_ROLE = "### ", "</turn>", ": "
_CONTROL = re.compile(CONTROL)
_CONTROL_OR_COLON = re.compile(CONTROL + "|:")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_SEGMENT = re.compile(r"### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)

TRAINED = ("assistant",)
PART = "struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
ATTACHMENTS = "array<struct<number: bigint, type: string, ref: string, at: int, tokens: bigint>>"
SEGMENTS = (
    "position bigint, role string, segment string, start bigint, loss_start int, loss_end int, "
    f"attachments {ATTACHMENTS}, n_tokens bigint"
)


@dataclass(frozen=True)
class Expansion:
    """Tokens that an attachment stands for: images by patches, audio by seconds, documents by pages."""

    patch: int = 28
    audio_rate: float = 25.0
    page_tokens: int = 1024

    def image(self, part: dict) -> int:
        return math.ceil((part["width"] or 0) / self.patch) * math.ceil((part["height"] or 0) / self.patch)

    def audio(self, part: dict) -> int:
        return math.ceil(max(part["seconds"] or 0.0, 0.0) * self.audio_rate)

    def document(self, part: dict) -> int:
        return max(part["pages"] or 0, 0) * self.page_tokens


@dataclass
class Flattener:
    """Visits the parts of one turn in order; ``attached`` attachments stand before it in its conversation."""

    expansion: Expansion
    attached: int = 0
    pieces: list[str] = field(default_factory=list)
    length: int = 0
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict | None) -> None:
        """A null part adds nothing; one of an unknown type stands as an attachment of no tokens."""
        if part is None:
            return
        kind = re.sub(r"\W", "_", part["type"] or "text")
        if kind == "text":
            self._add(escaped(part["text"] or ""))
            return
        number = self.attached + len(self.attachments) + 1
        tokens = getattr(self.expansion, kind)(part) if kind in ("image", "audio", "document") else 0
        self.attachments.append({"number": number, "type": kind, "ref": part["ref"], "at": self.length, "tokens": tokens})
        self._add(f"<|{kind}:{number}|>")

    def _add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.length += len(piece)


def escaped(text: str) -> str:
    return _CONTROL.sub(r"\\\g<0>", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parts_of(content: str) -> list[dict]:
    """The typed parts of a formatted turn's content: texts unescaped, placeholders with type and number."""
    parts, at, text = [], 0, ""
    for found in re.finditer(r"\\.|<\|(\w+):(\d+)\|>", content, re.DOTALL):
        text += content[at : found.start()]
        if found[1] is None:
            text += found[0][1:]
        else:
            if text:
                parts.append({"type": "text", "text": text})
            parts.append({"type": found[1], "number": int(found[2])})
            text = ""
        at = found.end()
    text += content[at:]
    return [*parts, {"type": "text", "text": text}] if text else parts


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """(role, content) of every turn of a conversation's whole formatted text."""
    turns, at = [], 0
    while at < len(formatted):
        found = _SEGMENT.match(formatted, at)
        if found is None:
            raise ValueError(f"not a formatted turn: {formatted[at : at + 80]!r}")
        turns.append((unescaped(found[1]), unescaped(found[2])))
        at = found.end()
    return turns


def format_turns(
    rows: DataFrame, *, trained: tuple[str, ...] = TRAINED, expansion: Expansion = Expansion(), parts: str | None = None
) -> DataFrame:
    """A formatted segment for each row of (conv_id, turn, role, text); ``parts`` names a column of
    ``array<PART>`` that stands in for the text where it is not null.

    ``n_tokens`` is what a turn's attachments expand to. ``start`` counts code points from the beginning of
    the conversation, ``loss_start``, ``loss_end`` and an attachment's ``at`` from that of the segment."""
    prepared(rows.sparkSession)
    content = F.col(parts).cast(f"array<{PART}>") if parts else F.lit(None).cast(f"array<{PART}>")
    turns = rows.select(
        "conv_id",
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *([content.alias("parts")] if parts else []),
    )
    order = ["conv_id", "turn", "role", "text"] + ([F.to_json("parts")] if parts else [])
    turns = turns.repartition("conv_id").sortWithinPartitions(*order).drop("turn")
    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, {SEGMENTS}"
    target = _arrow(schema)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, here, position, start, attached = False, None, 0, 0, 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if not known or row["conv_id"] != here:
                    known, here, position, start, attached = True, row["conv_id"], 0, 0, 0
                visitor = Flattener(expansion, attached)
                given = row.get("parts")
                for part in [{"type": "text", "text": row["text"]}] if given is None else given:
                    visitor.visit(part)
                head = HEAD + _CONTROL_OR_COLON.sub(r"\\\g<0>", row["role"]) + AFTER_ROLE
                segment = head + "".join(visitor.pieces) + END + "\n"
                loss = row["role"] in trained
                position += 1
                attached += len(visitor.attachments)
                out.append(
                    {
                        "conv_id": here,
                        "position": position,
                        "role": row["role"],
                        "segment": segment,
                        "start": start,
                        "loss_start": len(head) if loss else None,
                        "loss_end": len(head) + visitor.length if loss else None,
                        "attachments": [x | {"at": x["at"] + len(head)} for x in visitor.attachments],
                        "n_tokens": sum(x["tokens"] for x in visitor.attachments),
                    }
                )
                start += len(segment)
            yield pa.RecordBatch.from_pylist(out, schema=target)

    return turns.mapInArrow(segments, schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, position, role, content, loss) of each segment, from the formatted text and its spans alone:
    ``content`` is the unescaped text with its placeholders, ``loss`` the unescaped text under the mask."""
    prepared(formatted.sparkSession)
    kind = formatted.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, position bigint, role string, content string, loss string, n_chars bigint"
    target = _arrow(schema)

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                found = _SEGMENT.fullmatch(row["segment"])
                if found is None:
                    raise ValueError(f"not a formatted turn: {row['segment'][:80]!r}")
                masked = row["loss_start"] is not None
                loss = unescaped(row["segment"][row["loss_start"] : row["loss_end"]]) if masked else None
                out.append(
                    {
                        "conv_id": row["conv_id"],
                        "position": row["position"],
                        "role": unescaped(found[1]),
                        "content": unescaped(found[2]),
                        "loss": loss,
                        "n_chars": len(row["segment"]),
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema=target)

    return formatted.select("conv_id", "position", "segment", "loss_start", "loss_end").mapInArrow(turns, schema)


def assembled(formatted: DataFrame) -> DataFrame:
    """One row per conversation with its formatted text, for conversations that fit into a value."""
    pieces = F.sort_array(F.collect_list(F.struct("position", "segment")))
    return formatted.groupBy("conv_id").agg(F.array_join(pieces["segment"], "").alias("formatted"))


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation, of rows from ``read_back``: n_turns, the digest of its turns and of its loss text.

    A digest takes its bytes in order, so the rows of a conversation pass through one task as a stream."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint"
    )
    target = _arrow(schema)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, here, of = False, None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if not known or row["conv_id"] != here:
                    if known:
                        out.append(of.row(here))
                    known, here, of = True, row["conv_id"], _Digest()
                of.add(row)
            yield pa.RecordBatch.from_pylist(out, schema=target)
        if known:
            yield pa.RecordBatch.from_pylist([of.row(here)], schema=target)

    return turns.mapInArrow(summed, schema)


class _Digest:
    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, row: dict) -> None:
        self.n_turns += 1
        self.chars += row["n_chars"]
        self.turns.update(f"{row['role']}\n{row['content']}\n".encode("utf-8", "surrogatepass"))
        if row["loss"] is not None:
            self.loss_chars += len(row["loss"])
            self.loss.update(row["loss"].encode("utf-8", "surrogatepass"))

    def row(self, conv_id: object) -> dict:
        return {
            "conv_id": conv_id,
            "n_turns": self.n_turns,
            "turns_sha256": self.turns.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.chars,
        }


def formatted_digests(rows: DataFrame) -> DataFrame:
    """Format, read back, and digest: the rows of a conversation keep their order from the first step on,
    as the two others take each partition as it stands."""
    return digests(read_back(format_turns(rows)))


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))
