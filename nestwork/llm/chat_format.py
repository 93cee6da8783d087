"""Chat formatting (operator 3): columnar byte assembly of conversations.

Every turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``.  Control strings inside texts and
roles are escaped: a backslash goes between their first and second character, and where
backslashes already stand there, one more, so reading takes exactly one away again.

A batch is put together without a loop over its bytes: the lengths of all segments (headers,
pieces of text, escapes, ends) give cumulative offsets, these give for each byte of the
result the place it comes from, and gathers of a megabyte at a time fill the preallocated buffer, which is the
data buffer of the Arrow string column.  Code points are counted from the same bytes; the
loss mask is the span of each assistant text.

Rows are range-partitioned by conversation and turn, so even a conversation with a third of
all rows is formatted by many tasks; it comes out as parts (at most one for each batch of
rows) that carry their place.  ``digests`` reads the parts of a conversation in order and
streams them through the hashes with bounded memory.

Defined cases: null texts and roles are empty; rows without a conv_id form one conversation
with a null id; null turns come first; rows with equal turns are ordered by role and a hash
of their text, repeated rows stay; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, text_of

# The template's marks, and the control strings that are escaped inside texts.
START, END = b"<|im_start|>", b"<|im_end|>\n"
CONTROL = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
LOSS_ROLE = "assistant"

_INSIDE = "|".join(f"{re.escape(c[0])}\\\\*{re.escape(c[1:])}" for c in CONTROL)
_FIND = re.compile(f"(?=({_INSIDE}))".encode())
_ESCAPED = re.compile("|".join(f"(?<={re.escape(c[0])})\\\\(?=\\\\*{re.escape(c[1:])})" for c in CONTROL))
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
#: Bytes that are gathered at once.
GATHER = 1 << 20
_PARTS = "conv_id long, place long, turn long, role string, tie long, formatted string, loss array<struct<start:long,end:long>>"


def unescape(text: str) -> str:
    return _ESCAPED.sub("", text)


def _role_header(role: str) -> bytes:
    raw = role.replace("\\", "\\\\").replace("\n", "\\n").encode()
    for m in reversed(list(_FIND.finditer(raw))):
        raw = raw[:m.start() + 1] + b"\\" + raw[m.start() + 1:]
    return START + raw + b"\n"


def _role_of(header: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(header))


def assemble(roles: list[str], offsets: np.ndarray, content: np.ndarray, first: np.ndarray) -> tuple[pa.StringArray, pa.ListArray]:
    """The formatted strings and loss spans of a batch of turns.

    ``content`` holds the bytes of all texts and ``offsets`` their borders; a new string begins
    at each row of ``first``.
    """
    n = len(roles)
    names, role = np.unique(np.array(roles, dtype=object), return_inverse=True)
    heads = [_role_header(r) for r in names]
    pool = np.frombuffer(b"".join([END, b"\\", *heads]), np.uint8)
    head_at = len(END) + 1 + np.concatenate([[0], np.cumsum([len(h) for h in heads])])
    base = len(pool)  # places from here on are those of the content
    # escapes: a byte goes in after the first character of each control string that lies in one text
    spans = np.array([m.span(1) for m in _FIND.finditer(memoryview(content))], np.int64).reshape(-1, 2)
    owner = np.searchsorted(offsets, spans[:, 0], "right") - 1
    inside = spans[:, 1] <= offsets[owner + 1] if len(spans) else np.empty(0, bool)
    cut, owner = spans[inside, 0] + 1, owner[inside]
    per_row = np.bincount(owner, minlength=n)
    # segments of a row: head, text pieces with escapes between them, end
    row_at = np.concatenate([[0], np.cumsum(3 + 2 * per_row)])
    start, length = np.zeros(row_at[-1], np.int64), np.zeros(row_at[-1], np.int64)
    start[row_at[:-1]], length[row_at[:-1]] = head_at[role], np.diff(head_at)[role]
    start[row_at[1:] - 1], length[row_at[1:] - 1] = 0, len(END)
    nth = np.arange(len(cut)) - np.concatenate([[0], np.cumsum(per_row)])[owner]
    escape_at = row_at[owner] + 2 + 2 * nth
    start[escape_at], length[escape_at] = len(END), 1
    start[row_at[:-1] + 1] = base + offsets[:-1]
    start[escape_at + 1] = base + cut
    piece = np.ones(len(start), bool)
    piece[row_at[:-1]] = piece[row_at[1:] - 1] = piece[escape_at] = False
    stop = np.zeros(len(start), np.int64)
    stop[row_at[1:] - 2] = base + offsets[1:]
    stop[escape_at - 1] = base + cut
    length[piece] = (stop - start)[piece]
    place = np.concatenate([[0], np.cumsum(length)])
    shift = start - place[:-1]
    out = np.empty(place[-1], np.uint8)
    string_at = place[row_at[np.append(first, n)]]
    # the borders before which code points are counted
    borders = np.unique(np.concatenate([place[row_at[:-1] + 1], place[row_at[1:] - 1], string_at, [0, len(out)]]))
    points, seen = np.zeros(len(borders), np.int64), 0
    for a in range(0, len(out), GATHER):  # one block of bytes at a time
        b = min(a + GATHER, len(out))
        i, j = np.searchsorted(place, a, "right") - 1, np.searchsorted(place, b, "left")
        here = np.minimum(place[i + 1:j + 1], b) - np.maximum(place[i:j], a)
        at = np.arange(a, b) + np.repeat(shift[i:j], here)
        fixed = at < base
        out[a:b][fixed] = pool[at[fixed]]
        out[a:b][~fixed] = content[at[~fixed] - base]
        begun = np.concatenate([[0], np.cumsum((out[a:b] & 0xC0) != 0x80)])
        i, j = np.searchsorted(borders, a, "left"), np.searchsorted(borders, b, "right")
        points[i:j] = seen + begun[borders[i:j] - a]
        seen += begun[-1]
    counted = lambda x: points[np.searchsorted(borders, x)]
    text_from, text_to = counted(place[row_at[:-1] + 1]), counted(place[row_at[1:] - 1])
    strings = pa.StringArray.from_buffers(len(first), pa.py_buffer(string_at.astype(np.int32).tobytes()), pa.py_buffer(out))
    string_of = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
    scored = np.array([r == LOSS_ROLE for r in names], bool)[role]
    shift = counted(string_at[:-1])[string_of]
    loss = pa.StructArray.from_arrays(
        [pa.array((text_from - shift)[scored]), pa.array((text_to - shift)[scored])], names=["start", "end"])
    counts = np.bincount(string_of[scored], minlength=len(first))
    return strings, pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), loss)


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place = TaskContext.get().partitionId() << 40  # range partitions follow each other in order
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv_id").to_pylist()
        first = np.array([i for i in range(len(conv)) if not i or conv[i] != conv[i - 1]])
        text = batch.column("text")
        offsets = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1, 4 * text.offset).astype(np.int64)
        data = text.buffers()[2]
        content = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.empty(0, np.uint8)
        strings, loss = assemble(batch.column("role").to_pylist(), offsets - offsets[0], content, first)
        at = pa.array(first)
        places = pa.array(np.arange(place, place + len(first)))
        place += len(first)
        yield pa.RecordBatch.from_arrays([batch.column("conv_id").take(at), places, *(batch.column(c).take(at) for c in ("turn", "role", "tie")), strings, loss],
                                         names=["conv_id", "place", "turn", "role", "tie", "formatted", "loss"])


def format_conversations(turns: DataFrame) -> DataFrame:
    """Parts of formatted conversations: conv_id, place (a number that grows with the order), the first row's turn, role and tie, formatted, loss."""
    small_batches(turns.sparkSession)
    order = ["conv_id", "turn", "role", "tie"]
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), text_of("role").alias("role"),
                        F.xxhash64(text_of()).alias("tie"), text_of().alias("text"))
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_format, _PARTS)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted string."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        out.append((_role_of(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no turn at character {at}")
    return out


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of each conversation; its parts follow each other in order."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    now, state = None, None

    def finished(rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    def closed() -> list:
        return [now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]]

    for batch in batches:
        done = []
        for conv, text, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss"))):
            if state is None or conv != now:
                if state is not None:
                    done.append(closed())
                now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, said in parse(text):
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode())
            for span in loss:
                said = unescape(text[span["start"]:span["end"]])
                state[2] += len(said)
                state[3].update(said.encode())
            state[4] += len(text)
        if done:
            yield finished(done)
    if state is not None:
        yield finished([closed()])


def digests(parts: DataFrame) -> DataFrame:
    """Per conversation the contract's columns, read back from the formatted parts."""
    order = ["conv_id", "place"]
    return parts.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(
        _digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def chat_table(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The digests of all conversations and of conversation -1, whose texts hold control strings."""
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionAll(probe)
    return digests(format_conversations(rows))


#: DuckDB's view of the same rows (roles there hold no control strings).
ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(regexp_replace(regexp_replace(text,
      '(<)(\\*(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|<SYS>>|</SYS>>))', '\1\\\2', 'g'),
      '(\[)(\\*/?INST\])', '\1\\\2', 'g')) AS n FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(12 + length(role) + 1 + n + 11)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
