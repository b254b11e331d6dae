"""Chat transcripts from event logs.

An event has a conversation, a sequence number, a message and a kind: ``message`` opens a message or sets its text,
``delta`` appends to it, ``edit`` and ``regenerate`` replace what there is and later deltas append to that. ``fold`` gives the
final messages, grouped by message, so a conversation with many events is spread over its messages. ``render`` turns each
message into a segment of the template; a conversation is its segments in order:

    <s>role
    text</s>

Control strings inside a role or text get a backslash after their first character and backslashes are doubled, so
the text can be read back. The loss mask covers the texts of assistant messages, without the marks around them.

Defined results. A null text or role is empty. A null sequence number sorts first. Events of one message with the same
number are taken in the order message, regenerate, edit, delta, then by text. Messages at the same position are ordered
by role, text and message id. Unknown kinds raise an error. A delta without an opening starts from the empty text. A null
conv_id is a conversation. No events give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.llm.spark import arrow_schema, batches, map_batches

# The control strings of this and of common other templates.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>")
KINDS = ("message", "regenerate", "edit", "delta")
OPEN, CLOSE = "<s>", "</s>\n"


def fold(events: DataFrame) -> DataFrame:
    """``conv_id, position, message_id, role, text`` of the final messages of events ``conv_id, seq, message_id, kind,
    role, text``. The position is the first number of a message, the role that of its first event with one."""
    rank = F.coalesce(*(F.when(F.col("kind") == kind, i) for i, kind in enumerate(KINDS)), F.raise_error(F.concat(F.lit("unknown kind of event: "), F.coalesce("kind", F.lit("null")))))
    event = F.struct("seq", rank.cast("int").alias("rank"), F.coalesce("text", F.lit("")).alias("text"), "role")
    ordered = events.groupBy("conv_id", "message_id").agg(F.array_sort(F.collect_list(event)).alias("log"), F.min("seq").alias("position"))
    text = F.aggregate(
        "log",
        F.lit(""),
        lambda so_far, e: F.when(e["rank"] == KINDS.index("delta"), F.concat(so_far, e["text"])).otherwise(e["text"]),
    )
    roles = F.filter(F.transform("log", lambda e: e["role"]), lambda role: role.isNotNull())
    return ordered.select("conv_id", "position", "message_id", F.coalesce(F.get(roles, F.lit(0)), F.lit("")).alias("role"), text.alias("text"))


def escaped(column: Column) -> Column:
    out = F.replace(column, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROL:
        out = F.replace(out, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return out


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def render(messages: DataFrame) -> DataFrame:
    """``conv_id, position, message_id, segment, loss_start, loss_end``: code points of the segment under the loss
    mask, null where there are none."""
    role = F.replace(escaped(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit("\\n"))
    head = F.concat(F.lit(OPEN), role, F.lit("\n"))
    body = escaped(F.coalesce("text", F.lit("")))
    mine = F.col("role") == "assistant"
    return messages.select(
        "conv_id", "position", "message_id", "role", "text",
        F.concat(head, body, F.lit(CLOSE)).alias("segment"),
        F.when(mine, F.length(head)).alias("loss_start"),
        F.when(mine, F.length(head) + F.length(body)).alias("loss_end"),
    )


def transcripts(segments: DataFrame) -> DataFrame:
    """``conv_id, text, loss_spans``: each conversation as one text, with the spans of its loss mask. For conversations
    that fit in one value; longer ones stay segments."""
    row = F.struct("position", "role", "text", "message_id", "segment", "loss_start", "loss_end")
    whole = segments.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    spans = F.aggregate(
        "rows",
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans")),
        lambda state, r: F.struct(
            (state["at"] + F.length(r["segment"])).alias("at"),
            F.when(
                r["loss_start"].isNotNull(),
                F.concat(state["spans"], F.array(F.struct((state["at"] + r["loss_start"]).alias("start"), (state["at"] + r["loss_end"]).alias("end")))),
            ).otherwise(state["spans"]).alias("spans"),
        ),
    )
    return whole.select("conv_id", F.array_join("rows.segment", "").alias("text"), spans["spans"].alias("loss_spans"))


def read_back(segment: str) -> tuple[str, str]:
    """Role and text of a segment."""
    head, _, body = segment.removeprefix(OPEN).partition("\n")
    role = re.sub(r"\\(\\|n)?", lambda m: {"\\": "\\", "n": "\n", None: ""}[m[1]], head)
    return role, unescape(body.removesuffix(CLOSE))


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments sorted by conversation and order; one conversation's state at a time."""
    schema = arrow_schema(DIGESTS)
    out: dict[str, list] = {name: [] for name in schema.names}
    state = None

    def close():
        conv, turns, loss, counts = state
        values = (conv, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2])
        for name, value in zip(schema.names, values, strict=True):
            out[name].append(value)

    for batch in rows:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "segment", "loss_start", "loss_end")]
        for conv, segment, start, end in zip(*columns, strict=True):
            if state is None or state[0] != conv:
                if state is not None:
                    close()
                state = (conv, hashlib.sha256(), hashlib.sha256(), [0, 0, 0])
            _, turns, loss, counts = state
            role, text = read_back(segment)
            turns.update(f"{role}\n{text}\n".encode())
            counts[0] += 1
            counts[2] += len(segment)
            if start is not None:
                masked = unescape(segment[start:end])
                loss.update(masked.encode())
                counts[1] += len(masked)
        yield from batches(out, schema)
        for column in out.values():
            column.clear()
    if state is not None:
        close()
    yield from batches(out, schema)


def digests(segments: DataFrame) -> DataFrame:
    """Per conversation, read back from its segments: number and digest of the turns, length and digest of the text
    under the loss mask, length of the whole. A task streams through its conversations, whatever their length."""
    order = ("conv_id", "position", "role", "text", "message_id")
    dealt = segments.repartition("conv_id").sortWithinPartitions(*order)
    return map_batches(dealt.select("conv_id", "segment", "loss_start", "loss_end"), _digest, DIGESTS)
