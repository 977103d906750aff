"""Conversations as marked-up training text, with a loss mask, checked by reading every text back."""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripspot.llm.turns import ROWS, in_order, runs
from tripspot.session import Scratch

# The grammar: text = turn*, turn = START role NEWLINE body END NEWLINE; neither role nor body holds START or END.
START, END = "<|im_start|>", "<|im_end|>"
CONTROL = re.compile(r"<\|im_(?:start|end)\|>")
PLAIN = re.compile(r"<(\\*)\|im_(start|end)\|>")
ESCAPED = re.compile(r"<\\(\\*)\|im_(start|end)\|>")
LEARNED = "assistant"
FORMATTED = "part long, open boolean, formatted string, loss array<struct<start: int, end: int>>"
READ = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class Malformed(ValueError):
    """A text that the grammar does not derive."""


def escape(text: str) -> str:
    """A backslash more in each control string, with any number of backslashes before; `unescape` takes it away."""
    return PLAIN.sub(r"<\\\1|im_\2|>", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|im_\2|>", text)


def escape_role(role: str) -> str:
    """A role is one line, so its newlines are escaped, too."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn; the span is that of its body as it is written. One pass, no choices."""
    turns, at = [], 0
    while at < len(formatted):
        line = formatted.find("\n", at)
        if not formatted.startswith(START, at) or line < 0:
            raise Malformed(at)
        start = line + 1
        mark = CONTROL.search(formatted, start)
        if mark is None or mark[0] != END or formatted[mark.end() : mark.end() + 1] != "\n":
            raise Malformed(start)
        turns.append((unescape_role(formatted[at + len(START) : line]), unescape(formatted[start : mark.start()]), start, mark.start()))
        at = mark.end() + 1
    return turns


def _turn(role: str, text: str) -> str:
    return f"{START}{role}\n{text}{END}\n"


def reads_as(formatted: str, source: list[tuple[str, str]]):
    """The parsed turns if they equal the source, else None."""
    try:
        turns = parse(formatted)
    except Malformed:
        return None
    return turns if [t[:2] for t in turns] == source else None


def render(source: list[tuple[str, str]]):
    """The text of some turns, and its turns as read back, which equal the source.

    Turns are written as they are. Where the text read back differs, the turns that conflict (each read alone) are
    escaped and the text is written and read again, until it is identical.
    """
    written = list(source)
    while True:
        formatted = "".join(_turn(*t) for t in written)
        turns = reads_as(formatted, source)
        if turns is not None:
            return formatted, turns
        plain = [i for i, t in enumerate(written) if t == source[i]]
        wrong = [i for i in plain if reads_as(_turn(*written[i]), [source[i]]) is None] or plain
        changed = [(i, (escape_role(source[i][0]), escape(source[i][1]))) for i in wrong]
        if all(t == source[i] for i, t in changed):
            raise Malformed("escaping left the text as it was")
        for i, t in changed:
            written[i] = t


def _format(batches, part_rows, types):
    for table, start, open_, number in runs(batches, rows=part_rows):
        roles, texts = table.column("role").to_pylist(), table.column("text").to_pylist()
        ends = np.append(start[1:], table.num_rows)
        out, loss = [], []
        for i, j in zip(start, ends):
            formatted, turns = render(list(zip(roles[i:j], texts[i:j])))
            out.append(formatted)
            loss.append([{"start": s, "end": e} for role, _, s, e in turns if role == LEARNED])
        columns = [number + np.arange(len(start)), open_, out, loss]
        convs = table.column("conv").take(pa.array(start)).combine_chunks()
        arrays = [pa.array(c, f.type) for c, f in zip(columns, list(types)[1:])]
        yield pa.RecordBatch.from_arrays([convs, *arrays], schema=types)


def _read(batches, types):
    """Digests of the turns that a conversation's parts, in order, give back."""
    held = None  # conversation and its sums so far
    for batch in batches:
        done = []
        for conv, formatted, loss in zip(*(batch.column(c).to_pylist() for c in ("conv", "formatted", "loss"))):
            if held is None or held[0] != conv:
                done += [held] if held else []
                held = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text, _, _ in parse(formatted):
                held[1] += 1
                held[2].update(f"{role}\n{text}\n".encode())
            for span in loss:
                text = unescape(formatted[span["start"] : span["end"]])
                held[3] += len(text)
                held[4].update(text.encode())
            held[5] += len(formatted)
        yield _digests(done, types)
    yield _digests([held] if held else [], types)


def _digests(done, types):
    rows = [(c, n, t.hexdigest(), k, m.hexdigest(), f) for c, n, t, k, m, f in done]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(types)], schema=types)


def _types(spark, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def format_conversations(rows: DataFrame, scratch: Scratch, conv_col="conv_id", part_rows=ROWS) -> DataFrame:
    """Formatted conversations: conv_id, part, open, formatted, loss (spans of the assistant's bodies in code points).

    Each text has been read back by a deterministic parser and gave its source turns; turns that did not are escaped.
    A conversation is one row, unless it lies at the border of a task or is very long: then its parts, in the order of
    their numbers, make up its text, and `open` is true. So no task holds more than a part.

    Turns are taken by number (null first), then role and the MD5 of the text; equal rows are turns of their own. A
    null role or text is empty. A null id is a conversation of its own. Extra columns are ignored; an empty table
    gives no rows.
    """
    own = rows.select(
        F.col(conv_col).alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    own = in_order(own)
    schema = f"conv {own.schema['conv'].dataType.simpleString()}, {FORMATTED}"
    write = functools.partial(_format, part_rows=part_rows, types=_types(rows.sparkSession, schema))
    return scratch.store(own.mapInArrow(write, schema).withColumnRenamed("conv", conv_col), "formatted")


def read_conversations(formatted: DataFrame, conv_col="conv_id") -> DataFrame:
    """One row per conversation, read back from its text: conv_id, n_turns, turns_sha256 (of role, newline, text, newline
    for each turn), loss_chars and loss_sha256 (of the unescaped text under the loss mask), formatted_chars.

    Conversations of one row are read where they lie. Only the few in parts are brought together, in order, and pass
    a task part by part: a digest has no parallel form.
    """
    named = formatted.withColumnRenamed(conv_col, "conv")
    schema = f"conv {named.schema['conv'].dataType.simpleString()}, {READ}"
    read = functools.partial(_read, types=_types(formatted.sparkSession, schema))
    columns = ["conv", "part", "formatted", "loss"]
    whole = named.filter("not open").select(columns).mapInArrow(read, schema)
    parts = named.filter("open").select(columns).repartition("conv").sortWithinPartitions("conv", "part")
    return whole.unionByName(parts.mapInArrow(read, schema)).withColumnRenamed("conv", conv_col)
