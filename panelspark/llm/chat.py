"""Chat formatting by columnar byte assembly.

A turn is written as <|im_start|>role, a line end, the text, <|im_end|>, a line end. Inside roles and texts a
backslash is doubled and ``<|`` becomes ``<\\|``, so that no text holds a control string; role line ends become ``\\n``.
A batch of turns is assembled at once: segment lengths, running offsets and scatter indices in numpy, headers and contents
copied into one buffer, which becomes the Arrow column. Rows are sorted by conversation and turn and stream through the
tasks; a conversation longer than a batch is written as several chunks, so memory is bounded by a batch.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The template
START, END = b"<|im_start|>", b"<|im_end|>\n"
TRAINED_ROLE = "assistant"

CHUNKS = "conv_id long, chunk int, formatted binary, n_turns long, loss_start array<long>, loss_end array<long>"
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
           "loss_spans long")

_TURN = re.compile(rb"<\|im_start\|>([^\n]*)\n((?:[^<]|<(?!\|))*)<\|im_end\|>\n")
_ESCAPED = re.compile(rb"\\(.)", re.S)


def escape(texts: pa.Array) -> pa.Array:
    """Texts without control strings; NULL becomes empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    return pc.replace_substring(pc.replace_substring(texts, "\\", "\\\\"), "<|", "<\\|")


def unescape(data: bytes) -> bytes:
    return _ESCAPED.sub(lambda m: b"\n" if m[1] == b"n" else m[1], data) if b"\\" in data else data


def _span(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a large string column."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


def _scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copy segment i of ``data`` to ``out`` from ``at[i]`` on."""
    n = np.diff(offsets)
    moved = np.repeat(at - offsets[:-1], n)
    out[moved + np.arange(offsets[0], offsets[-1])] = data[offsets[0]:offsets[-1]]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the turns one after the other, the offset of each turn, and of each turn's text."""
    role = pc.replace_substring(escape(roles), "\n", "\\n")
    text = escape(texts)
    (r_data, r_at), (t_data, t_at) = _span(role), _span(text)
    r_len, t_len = np.diff(r_at), np.diff(t_at)
    turn = np.concatenate([[0], np.cumsum(len(START) + r_len + 1 + t_len + len(END))])
    out = np.empty(turn[-1], np.uint8)
    role_at = turn[:-1] + len(START)
    text_at = role_at + r_len + 1
    out[turn[:-1, None] + np.arange(len(START))] = np.frombuffer(START, np.uint8)
    _scatter(out, role_at, r_data, r_at)
    out[text_at - 1] = ord("\n")
    _scatter(out, text_at, t_data, t_at)
    out[(text_at + t_len)[:, None] + np.arange(len(END))] = np.frombuffer(END, np.uint8)
    return out, turn, text_at


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """Chunks of formatted conversations with the byte spans under the loss mask (texts of assistant turns).

    Turns are in order of turn (NULL first), then role, then text. A NULL text or role is empty; a NULL conversation id
    is a conversation of its own; repeated rows are repeated turns. Other columns are ignored; an empty table gives no
    rows. A conversation is one ordered stream, so its rows pass through one task, batch by batch.
    """
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, chunk = (), 0
        for b in batches:
            if not b.num_rows:
                continue
            conv = b.column(0).to_pylist()
            out, turn, text_at = assemble(b.column(1), b.column(2))
            first = np.array([i for i in range(len(conv)) if i == 0 or conv[i] != conv[i - 1]] + [len(conv)])
            at = turn[first]
            trained = np.array([r == TRAINED_ROLE for r in b.column(1).to_pylist()])
            chunks = []
            for i in first[:-1]:
                chunk = chunk + 1 if (conv[i],) == last else 0
                last = (conv[i],)
                chunks.append(chunk)
            starts, ends = [], []
            for i, j in zip(first[:-1], first[1:]):
                mine = np.flatnonzero(trained[i:j]) + i
                starts.append(text_at[mine] - turn[i])
                ends.append(turn[mine + 1] - len(END) - turn[i])
            formatted = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(at) - 1, [None, pa.py_buffer(np.ascontiguousarray(at, np.int64)), pa.py_buffer(out)])
            yield pa.RecordBatch.from_pydict({
                "conv_id": pa.array([conv[i] for i in first[:-1]], pa.int64()), "chunk": pa.array(chunks, pa.int32()),
                "formatted": formatted.cast(pa.binary()), "n_turns": pa.array(np.diff(first), pa.int64()),
                "loss_start": pa.array(starts, pa.list_(pa.int64())), "loss_end": pa.array(ends, pa.list_(pa.int64()))})

    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(role_col).alias("role"),
                        F.col(text_col).alias("text"), F.col(turn_col).alias("turn"))
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text").mapInArrow(build, CHUNKS))


def digests(chunks: DataFrame) -> DataFrame:
    """Turns, hashes and lengths per conversation, parsed from the formatted bytes and the loss spans."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = (), None

        def done() -> pa.RecordBatch:
            n, all_, chars, loss, size, spans = state
            return pa.RecordBatch.from_pydict({
                "conv_id": pa.array([now[0]], pa.int64()), "n_turns": [n], "turns_sha256": [all_.hexdigest()],
                "loss_chars": [chars], "loss_sha256": [loss.hexdigest()], "formatted_chars": [size], "loss_spans": [spans]})

        for b in batches:
            for i in range(b.num_rows):
                conv, data = b.column(0)[i].as_py(), b.column(1)[i].as_py()
                if (conv,) != now:
                    if now:
                        yield done()
                    now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                at = 0
                for m in _TURN.finditer(data):
                    if m.start() != at:
                        raise ValueError(f"conversation {conv}: byte {at} is outside a turn")
                    state[0], at = state[0] + 1, m.end()
                    state[1].update(unescape(m[1]) + b"\n" + unescape(m[2]) + b"\n")
                if at != len(data):
                    raise ValueError(f"conversation {conv}: bytes after the last turn")
                for s, e in zip(b.column(2)[i].as_py(), b.column(3)[i].as_py()):
                    text = unescape(data[s:e])
                    state[2] += len(text.decode())
                    state[3].update(text)
                    state[5] += 1
                state[4] += len(data.decode())
        if now:
            yield done()

    return (chunks.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
            .select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(read, DIGESTS))
