"""Chat formatting: conversations through a compiled template, with loss masks, and back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow
from .templates import BEGIN, END, Template

#: Control strings of the format.  Each begins with < or [, which are nowhere else in it, so occurrences never overlap.
START, TURN, TEXT, CLOSE = "<s>", "<|turn|>", "<|text|>", "</s>"
CONTROL = (START, CLOSE, TURN, TEXT, "[INST]", "[/INST]")
TEMPLATE = """\
{{ '<s>' }}{% for message in messages -%}
{{ '<|turn|>' + (message.role | escape) + '<|text|>' }}
{%- if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}
{%- else %}{{ message.text | escape }}{% endif -%}
{{ '</s>' }}{% endfor %}"""
CHUNK_CHARS = 1 << 20

_control = re.compile("|".join(map(re.escape, CONTROL)))


def escape(text: str) -> str:
    """The text without control strings: a backslash is doubled, and one is set behind the first character of a control string."""
    return _control.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def _chunks(template: Template, messages: Iterator[dict], size: int) -> Iterator[tuple[str, list[dict]]]:
    """The formatted text in pieces of about ``size`` characters, with the ranges under the loss mask."""
    out, spans, n, open_at = [], [], 0, None
    for piece in template.render(messages=messages):
        if piece is BEGIN:
            open_at = n
        elif piece is END:
            spans.append({"first": open_at, "end": n})
            open_at = None
        else:
            out.append(piece)
            n += len(piece)
            if n >= size:
                if open_at is not None:
                    spans.append({"first": open_at, "end": n})
                    open_at = 0
                yield "".join(out), spans
                out, spans, n = [], [], 0
    yield "".join(out), spans


class _Rows:
    """Sorted rows of a partition, one conversation after the other."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        self.rows = (row for b in batches for row in zip(*[c.to_pylist() for c in b.columns]))
        self.row = next(self.rows, None)

    def conversation(self, conv) -> Iterator[dict]:
        while self.row is not None and self.row[0] == conv:
            yield {"role": self.row[1], "text": self.row[2]}
            self.row = next(self.rows, None)


SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
FORMATTED = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("chunk", T.LongType()), T.StructField("text", T.StringType()),
                          T.StructField("mask", T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())])))])


def format_conversations(turns: DataFrame, template: str = TEMPLATE, chunk_chars: int = CHUNK_CHARS, conv: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, chunk, text, mask) in order of conv_id and chunk inside each partition.

    A conversation is one ordered text, so its turns meet in one task, sorted by Spark; there they stream through the template
    in bounded memory and come out in chunks of about ``chunk_chars`` characters.  ``mask`` holds the ranges of a chunk, in code points, that
    lie in generation blocks.  Turns are in order of turn (null first); ties by role, then text; repeated rows are all kept.
    A null role or text is empty; rows with a null conv_id form one conversation.  No turns, no rows; other columns are ignored.
    """
    Template(template, {"escape": escape})  # errors show before the job starts
    rows = turns.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"),
                        F.coalesce(text, F.lit("")).alias("text"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    rows = rows.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = Template(template, {"escape": escape})
        source, held, size = _Rows(batches), [], 0
        while source.row is not None:
            current = source.row[0]
            for n, (body, mask) in enumerate(_chunks(compiled, source.conversation(current), chunk_chars)):
                held.append((current, n, body, mask))
                size += len(body)
                if size >= 4 * chunk_chars:
                    yield _formatted(held)
                    held, size = [], 0
            for _ in source.conversation(current):  # what a template without a loop has left
                pass
        if held:
            yield _formatted(held)

    return map_arrow(rows, run, FORMATTED)


def _formatted(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()),
                                       pa.array(columns[3], SPANS)], names=["conv_id", "chunk", "text", "mask"])


class Reader:
    """Reads one formatted conversation back from its chunks."""

    def __init__(self):
        self.turns = self.chars = self.loss = 0
        self.digest, self.loss_digest = hashlib.sha256(), hashlib.sha256()
        self.rest, self.loss_rest, self.begun = "", "", False

    def feed(self, text: str, mask: list[dict]) -> None:
        self.chars += len(text)
        masked = self.loss_rest + "".join(text[m["first"]:m["end"]] for m in mask)
        odd = (len(masked) - len(masked.rstrip("\\"))) % 2  # an escape whose character is in the next chunk
        self.loss_rest = masked[len(masked) - odd:]
        plain = unescape(masked[:len(masked) - odd])
        self.loss += len(plain)
        self.loss_digest.update(plain.encode())
        rest = self.rest + text
        at = 0
        if not self.begun and len(rest) >= len(START):
            if not rest.startswith(START):
                raise ValueError("a conversation must begin with the start mark")
            self.begun, at = True, len(START)
        while self.begun and (end := rest.find(CLOSE, at)) >= 0:
            if not rest.startswith(TURN, at):
                raise ValueError("a turn must begin with the turn mark")
            role, found, body = rest[at + len(TURN):end].partition(TEXT)
            if not found:
                raise ValueError("a turn has no text mark")
            self.turns += 1
            self.digest.update(f"{unescape(role)}\n{unescape(body)}\n".encode())
            at = end + len(CLOSE)
        self.rest = rest[at:]

    def result(self) -> tuple:
        if self.rest or self.loss_rest:
            raise ValueError("a conversation ends inside a turn")
        return self.turns, self.digest.hexdigest(), self.loss, self.loss_digest.hexdigest(), self.chars


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from the partitions of ``format_conversations``."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, current, done = None, None, []
        for batch in batches:
            for conv, chunk, text, mask in zip(*[c.to_pylist() for c in batch.columns]):
                if chunk == 0:
                    if reader:
                        done.append((current, *reader.result()))
                    reader, current = Reader(), conv
                reader.feed(text, mask)
            if len(done) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
                done = []
        if reader:
            done.append((current, *reader.result()))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)

    return map_arrow(formatted, run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
