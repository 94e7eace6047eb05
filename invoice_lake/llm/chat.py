"""Chat formatting of messages with typed content parts.

A turn is written ``<|turn|>role<|text|>body<|end|>`` and a line break. In roles and texts every ``<``, ``[`` and backslash
is followed by an added backslash, so no control string survives inside a text and the escape can be undone. Images, audio
and documents become the placeholders ``<|image|>``, ``<|audio|>`` and ``<|document|>``; the attachments are listed in the
order of their placeholders.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END, TRAINED_ROLE = "<|turn|>", "<|text|>", "<|end|>\n", "assistant"
#: Tokens that a unit of an attachment expands to: an image tile, a second of audio, a page.
UNIT_TOKENS = {"image": 256, "audio": 25, "document": 600}
_SPECIAL, _ESCAPED = re.compile(r"[<\[\\]"), re.compile(r"([<\[\\])\\")
_TURN = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>\n", re.S)
_PLACEHOLDER = re.compile(r"<\|(?:image|audio|document)\|>")
_PARTS = "array<struct<type: string, text: string, uri: string, units: long>>"
_ATTACHMENTS = "array<struct<type: string, uri: string, tokens: long>>"


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass
class PartVisitor:
    """Flattens the parts of one message; ``visit`` calls the method of the part's type."""

    unit_tokens: dict[str, int]
    body: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        handler = getattr(self, f"visit_{part['type'] or 'text'}", None)
        if handler is None:
            raise ValueError(f"unknown content type {part['type']!r}")
        handler(part)

    def visit_text(self, part: dict) -> None:
        self.body.append(escape(part["text"] or ""))

    def visit_image(self, part: dict) -> None:
        self._attach("image", part)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part)

    def visit_document(self, part: dict) -> None:
        self._attach("document", part)

    def _attach(self, kind: str, part: dict) -> None:
        self.body.append(f"<|{kind}|>")
        units = 1 if part["units"] is None else part["units"]
        self.attachments.append({"type": kind, "uri": part["uri"], "tokens": units * self.unit_tokens[kind]})


def _flatten(batches: Iterator[pa.RecordBatch], unit_tokens: dict[str, int]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("type", pa.string()), ("uri", pa.string()), ("tokens", pa.int64())]))
    for batch in batches:
        heads, bodies, found = [], [], []
        for role, parts in zip(batch.column("role").to_pylist(), batch.column("parts").to_pylist()):
            visitor = PartVisitor(unit_tokens)
            for part in parts or []:
                if part is not None:
                    visitor.visit(part)
            heads.append(TURN + escape(role or "") + TEXT)
            bodies.append("".join(visitor.body))
            found.append(visitor.attachments)
        yield pa.RecordBatch.from_arrays([
            batch.column("conv_id"), batch.column("turn"), pa.array([r == TRAINED_ROLE for r in batch.column("role").to_pylist()]),
            pa.array(heads, pa.string()), pa.array(bodies, pa.string()), pa.array(found, kind)],
            ["conv_id", "turn", "trained", "head", "body", "attachments"])


def text_parts(text: str = "text"):
    """A content column of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), F.col(text).alias("text"), F.lit(None).cast("string").alias("uri"),
                            F.lit(None).cast("long").alias("units"))).cast(_PARTS).alias("parts")


def format_chats(messages: DataFrame, unit_tokens: dict[str, int] | None = None) -> DataFrame:
    """One row per conversation of ``messages`` (conv_id, turn, role, parts).

    Returns conv_id, formatted, loss_spans (code-point ranges of the assistant bodies in ``formatted``, in order) and attachments
    (type, uri, expanded tokens). ``parts`` is an array of (type, text, uri, units). Turns are ordered by turn, then by role
    and content; a null turn comes first. Null texts, parts and roles are empty, a part without units has one. An unknown
    type fails. A null conv_id is a conversation too. No rows give no rows. Turns are flattened before the shuffle; a
    conversation is one row of the result and so must fit one.
    """
    ids, turns = (messages.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    flat = messages.select("conv_id", "turn", "role", F.col("parts").cast(_PARTS).alias("parts")).mapInArrow(
        lambda batches: _flatten(batches, unit_tokens or UNIT_TOKENS),
        f"conv_id {ids}, turn {turns}, trained boolean, head string, body string, attachments {_ATTACHMENTS}")
    order = Window.partitionBy("conv_id").orderBy("turn", "head", "body")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    head, body = F.char_length("head").cast("long"), F.char_length("body").cast("long")
    placed = flat.withColumn("place", F.row_number().over(order)).withColumn(
        "begin", F.coalesce(F.sum(head + body + len(END)).over(before), F.lit(0).cast("long")) + head)
    span = F.when(F.col("trained"), F.struct("begin", (F.col("begin") + body).alias("end")))
    row = F.struct("place", F.concat("head", "body", F.lit(END)).alias("piece"), "attachments")
    gathered = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(row)).alias("turns"), F.sort_array(F.collect_list(span)).alias("loss_spans"))
    return gathered.select(
        "conv_id", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"), "loss_spans",
        F.flatten(F.transform("turns", lambda t: t["attachments"])).alias("attachments"))


def parse(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn; placeholders are left out."""
    return [(unescape(role), unescape(_PLACEHOLDER.sub("", body))) for role, body in _TURN.findall(formatted)]


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):  # a conversation may be long
            formatted = batch.column("formatted")[row].as_py()
            turns, whole, loss, n = parse(formatted), sha256(), sha256(), 0
            for role, text in turns:
                whole.update(f"{role}\n{text}\n".encode())
            for span in batch.column("loss_spans")[row].as_py():
                text = unescape(_PLACEHOLDER.sub("", formatted[span["begin"]:span["end"]]))
                n += len(text)
                loss.update(text.encode())
            yield pa.RecordBatch.from_arrays([
                batch.column("conv_id").slice(row, 1), pa.array([len(turns)], pa.int64()), pa.array([whole.hexdigest()]),
                pa.array([n], pa.int64()), pa.array([loss.hexdigest()]), pa.array([len(formatted)], pa.int64())],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def read_back(chats: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the loss mask, from formatted conversations alone."""
    kind = chats.schema["conv_id"].dataType.simpleString()
    return chats.select("conv_id", "formatted", "loss_spans").mapInArrow(
        _read_back, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
