r"""Chat formatting with typed content parts.

A turn's content is a list of parts: text, image, audio or document. A visitor flattens them in order: text is escaped, every other part becomes
a numbered placeholder, its reference is recorded, and the tokens it will expand to are counted. A turn is written as

    <|turn|>role\n content <|end|>\n

and a text cannot forge this or other common control strings: a backslash is put behind the `<` or `[` that opens one (and behind the
backslashes that already stand there), and one is taken away on reading. The loss mask lists the spans of the assistant's texts.

Turns are flattened where they lie. Then a partition gets whole conversations, sorted, and writes each as a stream of chunks of whole turns, so no
conversation is ever held in memory. Reading is a stream as well.

Cases: null text is empty; a null role is the empty role; turns are ordered by turn, role, content, and equal rows follow each other; null
turns come first and null conv_ids are one conversation; null or unknown parts raise for unknown kinds and are skipped for null; an empty
table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>"
CHUNK_CHARS = 1_000_000
PATCH = 28  # pixels of one image token's side
AUDIO_RATE = 25  # tokens a second
PAGE_TOKENS = 600
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
_CONTROL = r"(?=\||/?s>|/?SYS>|/?INST\])"
_OPEN = re.compile(r"([<\[])(\\*)" + _CONTROL)
_OPENED = re.compile(r"([<\[])(\\*)\\" + _CONTROL)
_PLACEHOLDER = re.compile(r"<\|(?:image|audio|document):\d+\|>")


def escape(text: str) -> str:
    return _OPEN.sub(r"\1\2\\", text)


def unescape(text: str) -> str:
    return _OPENED.sub(r"\1\2", text)


def escape_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


@dataclass
class Flattener:
    """Visits the parts of one turn in order."""

    out: list[str] = field(default_factory=list)
    spans: list[tuple[int, int]] = field(default_factory=list)
    refs: list[tuple[int, str, str | None, int]] = field(default_factory=list)
    size: int = 0
    pending: str = ""

    def visit(self, part: dict | None) -> None:
        if part is not None:
            handler = getattr(self, f"visit_{part['kind']}", None)
            if handler is None:
                raise ValueError(f"unknown part kind: {part['kind']}")
            handler(part)

    def visit_text(self, part: dict) -> None:
        self.pending += part["text"] or ""  # neighbours join before escaping, so no control string forms between them

    def visit_image(self, part: dict) -> None:
        self._attach(part, ceil((part["width"] or 0) / PATCH) * ceil((part["height"] or 0) / PATCH))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, ceil((part["seconds"] or 0) * AUDIO_RATE))

    def visit_document(self, part: dict) -> None:
        self._attach(part, (part["pages"] or 0) * PAGE_TOKENS)

    def _attach(self, part: dict, tokens: int) -> None:
        self.close()
        self.refs.append((len(self.refs), part["kind"], part["ref"], tokens))
        self._put(f"<|{part['kind']}:{len(self.refs) - 1}|>")

    def _put(self, text: str) -> None:
        self.out.append(text)
        self.size += len(text)

    def close(self) -> None:
        if self.pending:
            text = escape(self.pending)
            self.spans.append((self.size, self.size + len(text)))
            self._put(text)
            self.pending = ""


def format_turn(role: str | None, parts: list[dict | None] | None) -> tuple[str, list[tuple[int, int]], list[tuple[int, str, str | None, int]]]:
    """The turn's text, the spans of its text parts, its attachments."""
    visitor = Flattener()
    visitor._put(f"{TURN}{escape_role(role or '')}\n")
    for part in parts or ():
        visitor.visit(part)
    visitor.close()
    visitor._put(f"{END}\n")
    return "".join(visitor.out), visitor.spans, visitor.refs


def read_turns(text: str) -> Iterator[tuple[str, str]]:
    """(role, content with placeholders) of each turn of a formatted text."""
    at = 0
    while at < len(text):
        line = text.index("\n", at)
        end = text.index(END + "\n", line)
        yield unescape_role(text[at + len(TURN) : line]), unescape(text[line + 1 : end])
        at = end + len(END) + 1


_REF = pa.struct([("number", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
FLAT = "conv_id bigint, turn bigint, segment string, loss array<struct<start:bigint,end:bigint>>, refs array<struct<number:int,kind:string,ref:string,tokens:bigint>>"
FORMATTED = "conv_id bigint, chunk int, turns int, text string, loss array<struct<start:bigint,end:bigint>>, refs array<struct<number:int,kind:string,ref:string,tokens:bigint>>"


def flatten(turns: DataFrame) -> DataFrame:
    """One row per row of (conv_id, turn, role, parts): the formatted turn."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segments, losses, refs = [], [], []
            for role, parts in zip(batch.column("role").to_pylist(), batch.column("parts").to_pylist(), strict=True):
                text, spans, found = format_turn(role, parts)
                segments.append(text)
                losses.append([{"start": a, "end": b} for a, b in spans] if role == "assistant" else [])
                refs.append([dict(zip(("number", "kind", "ref", "tokens"), r, strict=True)) for r in found])
            columns = [batch.column("conv_id"), batch.column("turn"), pa.array(segments, pa.string()), pa.array(losses, pa.list_(_SPAN)), pa.array(refs, pa.list_(_REF))]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "turn", "segment", "loss", "refs"])

    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "parts")
    return rows.mapInArrow(task, FLAT)


def format_conversations(turns: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Formatted conversations in chunks of whole turns: text, loss spans and attachments (numbered per turn) of each."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, chunk, count, size = None, 0, 0, 0
        texts: list[str] = []
        loss: list[dict] = []
        refs: list[dict] = []
        begun = False

        def close() -> pa.RecordBatch:
            values = [[conv], [chunk], [count], ["".join(texts)], [list(loss)], [list(refs)]]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.list_(_SPAN), pa.list_(_REF)]
            for held in (texts, loss, refs):
                held.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], ["conv_id", "chunk", "turns", "text", "loss", "refs"])

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "segment", "loss", "refs"))
            for conv_id, segment, spans, found in zip(*columns, strict=True):
                if begun and (conv_id != conv or size >= chunk_chars):
                    yield close()
                    chunk, count, size = chunk + 1 if conv_id == conv else 0, 0, 0
                conv, begun = conv_id, True
                loss += [{"start": s["start"] + size, "end": s["end"] + size} for s in spans]
                texts.append(segment)
                refs += found
                count, size = count + 1, size + len(segment)
        if begun:
            yield close()

    flat = flatten(turns).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment")
    return flat.mapInArrow(task, FORMATTED)


DIGEST = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, attachments bigint, expanded_tokens bigint"


def digests(formatted: DataFrame) -> DataFrame:
    """What each formatted conversation says when read back."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, begun = None, False
        turns_hash = loss_hash = hashlib.sha256()
        totals = [0, 0, 0, 0, 0]

        def row() -> list:
            return [conv, totals[0], turns_hash.hexdigest(), totals[1], loss_hash.hexdigest(), *totals[2:]]

        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "text", "loss", "refs"))
            for conv_id, text, loss, refs in zip(*columns, strict=True):
                if not begun or conv_id != conv:
                    if begun:
                        out.append(row())
                    conv, begun = conv_id, True
                    turns_hash, loss_hash, totals = hashlib.sha256(), hashlib.sha256(), [0, 0, 0, 0, 0]
                for role, content in read_turns(text):
                    turns_hash.update(f"{role}\n{content}\n".encode())
                    totals[0] += 1
                for span in loss:
                    learned = unescape(text[span["start"] : span["end"]])
                    loss_hash.update(learned.encode())
                    totals[1] += len(learned)
                totals[2] += len(text)
                totals[3] += len(refs)
                totals[4] += sum(r["tokens"] for r in refs)
            if out:
                yield _digest_batch(out)
        if begun:
            yield _digest_batch([row()])

    rows = formatted.select("conv_id", "chunk", "text", "loss", "refs").repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return rows.mapInArrow(task, DIGEST)


def _digest_batch(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in DIGEST.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def text_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, parts) of rows with plain text: one text part each."""
    null = {"kind": F.lit("text"), "text": F.coalesce("text", F.lit("")), "ref": None, "width": None, "height": None, "seconds": None, "pages": None}
    part = F.struct(*[(F.lit(v) if v is None else v).alias(k) for k, v in null.items()]).cast(PART)
    return conversations.select("conv_id", "turn", "role", F.array(part).alias("parts"))
