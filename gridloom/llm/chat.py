"""Conversations as training text: rows become messages, a compiled template renders them turn by turn."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.templates import compile_template, unescape
from gridloom.llm.workers import tidied

START, END = "<|im_start|>", "<|im_end|>"

#: Marks turns; what an assistant says is to be learned.
TEMPLATE = (
    "{%- for message in messages -%}"
    "{{ '<|im_start|>' + (message.role | escape_line) + '\\n' }}"
    "{%- if message.role == 'assistant' -%}{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{%- else -%}{{ message.text | escape }}{%- endif -%}"
    "{{ '<|im_end|>\\n' }}"
    "{%- endfor -%}"
)

SEGMENTS = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("text", pa.string()), ("learn", pa.bool_())])

#: Characters after which a batch of segments is given out.
BATCH_CHARS = 1 << 22


def rows(batches) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def in_batches(found: Iterator[dict], schema: pa.Schema, size) -> Iterator[pa.RecordBatch]:
    ready, held = [], 0
    for row in found:
        ready.append(row)
        held += size(row)
        if held > BATCH_CHARS:
            yield pa.RecordBatch.from_pylist(ready, schema)
            ready, held = [], 0
    yield pa.RecordBatch.from_pylist(ready, schema)


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Segments of the formatted conversations, in order: conv_id, part (from 0), text, learn (is it under the loss mask).

    A conversation is its parts joined; it is given out turn by turn, so that its length is bounded by nothing but disk.
    Rows of a conversation are messages by turn, null turns first, equal turns by role and text. Null text or role is
    empty; rows with a null conv_id are one conversation; repeated rows are repeated messages; other columns are
    ignored. Segments of one conversation stay together and in order in a task's output.
    """

    def segments(batches) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)

        def made() -> Iterator[dict]:
            for conv_id, own in groupby(rows(batches), lambda r: r["conv_id"]):
                part = 0
                for text, learn in render({"role": r["role"] or "", "text": r["text"] or "", "turn": r["turn"]} for r in own):
                    yield {"conv_id": conv_id, "part": part, "text": text, "learn": learn}
                    part += 1

        return in_batches(made(), SEGMENTS, lambda r: len(r["text"]) + 64)

    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(tidied(segments), "conv_id long, part long, text string, learn boolean")


def read_turns(segments: Iterator[dict]) -> Iterator[tuple[str, str, list[str]]]:
    """(role, text, texts under the mask) of each turn of one conversation, read back from its formatted segments."""
    held, learned = "", []
    for segment in segments:
        held += segment["text"]
        if segment["learn"]:
            learned.append(unescape(segment["text"]))
        while held.startswith(START) and (end := held.find(END + "\n")) >= 0:
            role, _, text = held[len(START):end].partition("\n")
            yield unescape(role), unescape(text), learned
            held, learned = held[end + len(END) + 1:], []
    if held:
        raise ValueError(f"not a formatted turn: {held[:80]!r}")


DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def digest_conversations(segments: DataFrame) -> DataFrame:
    """Per conversation: turns and learned text as read back from what ``format_conversations`` returned."""

    def digests(batches) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[dict]:
            for conv_id, own in groupby(rows(batches), lambda r: r["conv_id"]):
                chars, n, loss = 0, 0, 0
                all_turns, all_loss = hashlib.sha256(), hashlib.sha256()

                def counted() -> Iterator[dict]:
                    nonlocal chars
                    for x in own:
                        chars += len(x["text"])
                        yield x

                for role, text, learned in read_turns(counted()):
                    n += 1
                    all_turns.update(f"{role}\n{text}\n".encode())
                    for x in learned:
                        all_loss.update(x.encode())
                        loss += len(x)
                yield {"conv_id": conv_id, "n_turns": n, "turns_sha256": all_turns.hexdigest(), "loss_chars": loss,
                       "loss_sha256": all_loss.hexdigest(), "formatted_chars": chars}

        return in_batches(made(), DIGESTS, lambda r: 200)

    return segments.mapInArrow(tidied(digests), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
