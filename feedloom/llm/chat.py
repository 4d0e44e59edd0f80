"""Chat formatting: conversations rebuilt from their event log, then rendered with a loss mask.

Events carry ``conv_id, turn, copy, seq, kind, role, text``; kinds are ``start`` (opens a message and names its
role), ``delta`` (appends streamed text), ``edit`` (replaces the text) and ``regenerate`` (drops the text so
far).  Events are partitioned by message, sorted by sequence and folded one after another, so a task holds a
single message; conversations as long as a third of the log spread over all tasks.  Rendering is per message
too: a conversation's output is its segments in order.  Only its digest walks one conversation in one task,
as a hash over it must, again holding one segment at a time.

Template: ``<s>role\\n[INST] text [/INST]</s>\\n``, for the assistant ``<s>role\\ntext</s>\\n``, whose text is the
loss mask.  In roles and texts a backslash is doubled and a control string gets a backslash after its first
character (in roles a line feed gets one before it); reading drops each backslash and keeps what follows.

Defined results: null text or role is empty; null ids and turns are values of their own, first in order; rows
of one turn follow each other by role and text; an unopened message has an empty role; no events, no rows.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CONTROL = re.compile(r"\\|</?s>|\[/?INST\]")
KEPT = re.compile(r"\\(.)", re.DOTALL)
SEGMENT = re.compile(r"<s>((?:\\.|[^\\\n])*)\n(?:\[INST\] (.*) \[/INST\]</s>|(.*)</s>)\n", re.DOTALL)
LEARNED = "assistant"


def escape(text: str) -> str:
    """A doubled backslash and a marked control string, in one pass."""
    return CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return KEPT.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A message's segment, and the place of its loss mask (start, length; length -1 for none)."""
    head = f"<s>{escape(role).replace(chr(10), chr(92) + chr(10))}\n"
    body = escape(text)
    if role == LEARNED:
        return f"{head}{body}</s>\n", len(head), len(body)
    return f"{head}[INST] {body} [/INST]</s>\n", 0, -1


def read_back(segment: str) -> tuple[str, str]:
    """Role and text of a segment."""
    m = SEGMENT.fullmatch(segment)
    role = unescape(m[1])
    return role, unescape(m[3] if role == LEARNED else m[2])


def message_events(rows: DataFrame, chunk: int = 64) -> DataFrame:
    """The event log of finished conversations, as a serving system would have written it.

    Assistant texts are streamed as a draft, regenerated, and streamed again; other texts are typed in reverse
    and then edited.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    copy = F.row_number().over(W.partitionBy("conv_id", "turn").orderBy(role, text))
    named = rows.select("conv_id", "turn", copy.alias("copy"), role.alias("role"), text.alias("text"))
    last = f"greatest(length(text) - 1, 0) div {chunk}"
    streamed = F.expr(f"transform(sequence(0L, {last}), i -> struct('delta' as kind, '' as role, substring(text, cast(i * {chunk} + 1 as int), {chunk}) as text))")
    draft = F.expr("array(struct('delta' as kind, '' as role, reverse(text) as text))")
    start = F.expr("array(struct('start' as kind, role as role, '' as text))")
    again = F.expr("array(struct('regenerate' as kind, '' as role, '' as text))")
    edit = F.expr("array(struct('edit' as kind, '' as role, text as text))")
    log = F.when(F.col("role") == LEARNED, F.concat(start, draft, again, streamed)).otherwise(F.concat(start, draft, edit))
    return named.select("conv_id", "turn", "copy", F.posexplode(log).alias("seq", "event")).select("conv_id", "turn", "copy", "seq", "event.kind", "event.role", "event.text")


def _fold(batches):
    """Consecutive events of a message become one row; the message at the end of a batch goes on in the next."""
    at, role, parts = None, "", []

    def message():
        segment, start, length = render(role, "".join(parts))
        return (*at, segment, start, length)

    for batch in batches:
        out = []
        for conv, turn, copy, kind, who, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "copy", "kind", "role", "text")), strict=True):
            if at != (conv, turn, copy):
                if at is not None:
                    out.append(message())
                at, role, parts = (conv, turn, copy), "", []
            if kind == "start":
                role, parts = who or "", []
            elif kind == "delta":
                parts.append(text or "")
            elif kind == "edit":
                parts = [text or ""]
            elif kind == "regenerate":
                parts = []
        if out:
            yield _segments(out)
    if at is not None:
        yield _segments([message()])


def _segments(rows):
    names = ("conv_id", "turn", "copy", "segment", "mask_start", "mask_length")
    types = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def formatted(events: DataFrame) -> DataFrame:
    """Segments of every conversation in order (turn, copy), each with the place of its loss mask (-1: none)."""
    sent = events.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("copy").cast("int"), F.col("seq").cast("long"), "kind", "role", "text")
    dealt = sent.repartition("conv_id", "turn", "copy").sortWithinPartitions("conv_id", "turn", "copy", "seq")
    return dealt.mapInArrow(_fold, "conv_id long, turn long, copy int, segment string, mask_start int, mask_length int")


def _digest(batches):
    at, held = None, False
    for batch in batches:
        out = []
        for conv, segment, start, length in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segment", "mask_start", "mask_length")), strict=True):
            if not held or at != conv:
                if held:
                    out.append((at, turns, hashed.hexdigest(), loss, masked.hexdigest(), total))
                at, held = conv, True
                turns, loss, total, hashed, masked = 0, 0, 0, hashlib.sha256(), hashlib.sha256()
            role, text = read_back(segment)
            hashed.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            if length >= 0:
                learned = unescape(segment[start : start + length])
                masked.update(learned.encode("utf-8", "surrogatepass"))
                loss += len(learned)
            turns, total = turns + 1, total + len(segment)
        if out:
            yield _digests(out)
    if held:
        yield _digests([(at, turns, hashed.hexdigest(), loss, masked.hexdigest(), total)])


def _digests(rows):
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def digests(segments: DataFrame) -> DataFrame:
    """What the formatted output says when it is read back, one row per conversation."""
    dealt = segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "copy")
    return dealt.mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
