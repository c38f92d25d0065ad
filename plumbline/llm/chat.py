"""Chat formatting with compiled templates, loss spans, and the way back.

`format_conversations` renders each conversation with a template (see template.py) and marks
what stands in its generation blocks. A conversation's turns are streamed through the
closures in order and leave as pieces of bounded length, so a conversation of any length
takes the memory of one turn, and its output is several rows. (A template that uses its
messages other than in one loop gets them as a list instead.) Turns of a conversation have
to be in one order, so a conversation is the smallest unit of a task.

The escape filter replaces the backslash and the first character of all control strings, so
no control string can come from a text, and `unescape` restores it. `read_back` parses the
pieces to turns again.

Edge cases: a null text or role is empty. A null conversation id is one conversation. Turns
stand by turn number (null first), then role and text, so repeated rows follow each other.
An empty table has no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.arrow import chunks
from plumbline.llm.catalogue import query
from plumbline.llm.template import Template, compile_template

OPEN, SAYS, CLOSE = "<turn>", "<says>", "</turn>"
MARKS = re.compile(f"{OPEN}|{SAYS}|{CLOSE}")
TURNS = (
    "{%- for m in messages -%}"
    "<turn>{{ m.role | escape }}<says>"
    "{%- if m.role == 'assistant' -%}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{%- else -%}{{ m.text | escape }}{%- endif -%}"
    '{{ "</turn>\\n" }}'
    "{%- endfor -%}"
)
PIECE = "piece long, start long, text string, spans array<struct<from:long,to:long>>"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\l")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "<" if m[1] == "l" else m[1], text, flags=re.S)


def chat_template(source: str = TURNS) -> Template:
    return compile_template(source, {"escape": escape})


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for part in chunks(batches, "text"):
        yield from zip(*[part.column(n).to_pylist() for n in names])


def _batched(rows: Iterator[tuple], schema: pa.Schema, text: int, limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of at most about `limit` characters in the given column."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[text]) if text >= 0 else 1000
        if size > limit:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def cut(pieces: Iterator[tuple[str, bool]], limit: int) -> Iterator[tuple[int, int, str, list[dict]]]:
    """(number, start, text, spans) of at most `limit` characters each; at least one, which may be empty."""
    number, start, size, texts, spans = 0, 0, 0, [], []
    for text, learn in pieces:
        at = 0
        while at < len(text):
            if size == limit:
                yield number, start, "".join(texts), spans
                number, start, size, texts, spans = number + 1, start + size, 0, [], []
            part = text[at : at + limit - size]
            here = start + size
            if learn and spans and spans[-1]["to"] == here:
                spans[-1]["to"] += len(part)
            elif learn:
                spans.append({"from": here, "to": here + len(part)})
            texts.append(part)
            at, size = at + len(part), size + len(part)
    yield number, start, "".join(texts), spans


def format_conversations(turns: DataFrame, source: str = TURNS, *, key: str = "conv_id", piece_chars: int = 1_000_000) -> DataFrame:
    """(key, piece, start, text, spans): formatted conversations in pieces, spans in characters of the whole."""
    chat_template(source)  # errors of the template show here, not in a task
    kind = turns.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = chat_template(source)
        gather = iter if template.reads_once("messages") else list

        def rows(found: Iterator[tuple]) -> Iterator[tuple]:
            for own, group in groupby(found, itemgetter(0)):
                messages = gather({"role": role or "", "text": text or ""} for _, role, text in group)
                for piece in cut(template.pieces(messages=messages), piece_chars):
                    yield (own, *piece)

        first = next(batches, None)
        if first is None:
            return
        spans = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
        schema = pa.schema([(key, first.schema.field(key).type), ("piece", pa.int64()), ("start", pa.int64()), ("text", pa.string()), ("spans", spans)])
        yield from _batched(rows(_rows(_with(first, batches), [key, "role", "text"])), schema, 3)

    ordered = turns.select(key, "turn", "role", "text").repartition(key).sortWithinPartitions(key, "turn", "role", "text")
    return ordered.select(key, "role", "text").mapInArrow(run, f"{key} {kind.simpleString()}, {PIECE}")


def _with(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


class Reader:
    """Takes the pieces of one conversation in order; holds one turn at most."""

    def __init__(self) -> None:
        self.turns = self.loss = self.chars = 0
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()
        self.buffer, self.role, self.open = "", None, ""

    def feed(self, start: int, text: str, spans: list[dict]) -> None:
        self.chars += len(text)
        for span in spans:
            self._learn(text[span["from"] - start : span["to"] - start])
        self.buffer += text
        at = 0
        for mark in MARKS.finditer(self.buffer):
            between, at = self.buffer[at : mark.start()], mark.end()
            if mark[0] == SAYS:
                self.role = unescape(between)
            elif mark[0] == CLOSE:
                self.turns += 1
                self.turn_hash.update(f"{self.role}\n{unescape(between)}\n".encode())
        self.buffer = self.buffer[at:]

    def _learn(self, part: str) -> None:
        whole = self.open + part
        dangling = (len(whole) - len(whole.rstrip("\\"))) % 2
        self.open = "\\" if dangling else ""
        text = unescape(whole[: len(whole) - dangling])
        self.loss += len(text)
        self.loss_hash.update(text.encode())

    def row(self) -> tuple:
        return self.turns, self.turn_hash.hexdigest(), self.loss, self.loss_hash.hexdigest(), self.chars


READ = {"n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(), "loss_sha256": pa.string(), "formatted_chars": pa.int64()}


def read_back(formatted: DataFrame, *, key: str = "conv_id") -> DataFrame:
    """Per conversation what its formatted pieces say: turns, text under the loss mask, and digests of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(found: Iterator[tuple]) -> Iterator[tuple]:
            for own, group in groupby(found, itemgetter(0)):
                reader = Reader()
                for _, start, text, spans in group:
                    reader.feed(start, text, spans)
                yield (own, *reader.row())

        first = next(batches, None)
        if first is not None:
            schema = pa.schema([(key, first.schema.field(key).type), *READ.items()])
            yield from _batched(rows(_rows(_with(first, batches), [key, "start", "text", "spans"])), schema, -1)

    ordered = formatted.repartition(key).sortWithinPartitions(key, "piece").select(key, "start", "text", "spans")
    kind = formatted.schema[key].dataType.simpleString()
    return ordered.mapInArrow(run, f"{key} {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


PLANTED = "\\### Assistant: </turn> ok"


def with_planted(turns: DataFrame) -> DataFrame:
    """The turns and conversation -7, whose texts look like control strings."""
    columns = turns.select("conv_id", "turn", "role", "text")
    rows = [(-7, i, role, PLANTED) for i, role in enumerate(("user", "assistant"))]
    return columns.unionByName(turns.sparkSession.createDataFrame(rows, columns.schema))


_ESC = "replace(replace({0}, '\\', '\\\\'), '<', '\\l')"
SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT -7, 0, 'user', '{PLANTED}' UNION ALL SELECT -7, 1, 'assistant', '{PLANTED}'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  CAST(sum({len(OPEN + SAYS + CLOSE) + 1} + length({_ESC.format("role")}) + length({_ESC.format("text")})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


@query("op11_chat_formatting", SQL)
def op11_chat_formatting(t) -> DataFrame:
    formatted = format_conversations(with_planted(t("conversations")))
    return read_back(formatted)
