"""Chat formatting by columnar byte assembly.

Rows are dealt by conversation and sorted by turn. Each batch is assembled at
once: lengths of all segments (turn header, role, text, turn end) give the
offsets by a cumulative sum, and numpy copies constants and contents to their
places in one preallocated buffer that becomes the Arrow string column.

Template of a turn: ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and
texts each ``<|`` (also with backslashes in between) gets one more backslash, so
no content can look like a marker; ``unescape`` takes it off again. In roles,
backslashes and line breaks are escaped first, as the header ends at a break.
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

START, END = "<|im_start|>", "<|im_end|>"
# A longer conversation is written in parts of whole turns, so memory stays bounded.
PART_BYTES = 64 << 20
FORMATTED = "conv_id long, part long, text string, loss_starts array<long>, loss_ends array<long>"
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escape(column: pa.Array) -> pa.Array:
    """Add a backslash to every ``<|``, ``<\\|``, ``<\\\\|``, ..."""
    return pc.replace_substring_regex(column, pattern=r"<(\\*)\|", replacement=r"<\1\\|")


def unescape(text: str) -> str:
    """The text before ``escape``."""
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def _escape_role(column: pa.Array) -> pa.Array:
    column = pc.replace_substring(column, pattern="\\", replacement="\\\\")
    return escape(pc.replace_substring(column, pattern="\n", replacement="\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def _content(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column without nulls, and its offsets."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), offsets


def _scatter(out: np.ndarray, places: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copy the strings of ``data`` to ``places`` of ``out`` with one indexed assignment."""
    lengths = np.diff(offsets)
    targets = np.repeat(places - offsets[:-1], lengths) + np.arange(offsets[0], offsets[-1])
    out[targets] = data[offsets[0] : offsets[-1]]


def assemble(conv: list, roles: pa.Array, texts: pa.Array, part: int) -> pa.RecordBatch:
    """Format rows that are sorted by conversation and turn; ``part`` numbers the first conversation's row."""
    header, middle, end = (np.frombuffer(x.encode(), np.uint8) for x in (START, "\n", f"{END}\n"))
    assistant = np.asarray(pc.equal(roles, "assistant"))
    (role_data, role_at), (text_data, text_at) = _content(_escape_role(roles)), _content(escape(texts))
    role_len, text_len = np.diff(role_at), np.diff(text_at)
    turn = len(header) + role_len + len(middle) + text_len + len(end)
    starts = np.concatenate(([0], np.cumsum(turn)))
    out = np.empty(starts[-1], np.uint8)
    role_place = starts[:-1] + len(header)
    text_place = role_place + role_len + len(middle)
    for constant, place in ((header, starts[:-1]), (middle, role_place + role_len), (end, text_place + text_len)):
        out[place[:, None] + np.arange(len(constant))] = constant
    _scatter(out, role_place, role_data, role_at)
    _scatter(out, text_place, text_data, text_at)
    first = np.array([i for i in range(len(conv)) if i == 0 or conv[i] != conv[i - 1]], np.int64)
    rows = np.append(starts[first], starts[-1])
    # Code points before each byte, for the spans of the loss mask.
    points = np.concatenate(([0], np.cumsum((out & 0xC0) != 0x80)))
    of_turn = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(conv))))
    base = points[rows[:-1]][of_turn]
    spans = [(points[p] - base)[assistant] for p in (text_place, text_place + text_len)]
    counts = np.concatenate(([0], np.cumsum(np.bincount(of_turn[assistant], minlength=len(first)))))
    lists = [pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.array(s, pa.int64())) for s in spans]
    text = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(rows.astype(np.int64)), pa.py_buffer(out))
    parts = np.zeros(len(first), np.int64)
    parts[0] = part
    return pa.record_batch(
        [pa.array([conv[i] for i in first], pa.int64()), pa.array(parts), text.cast(pa.string()), *lists],
        ["conv_id", "part", "text", "loss_starts", "loss_ends"],
    )


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    part, last = 0, ()

    def flush(piece: pa.RecordBatch) -> pa.RecordBatch:
        nonlocal part, last
        conv = piece.column("conv_id").to_pylist()
        part = part + 1 if last == (conv[0],) else 0
        made = assemble(conv, *(pc.fill_null(piece.column(c), "") for c in ("role", "text")), part)
        part, last = part if len(made) == 1 else 0, (conv[-1],)
        return made

    for batch in batches:
        # Slices of bounded bytes, as indices take eight bytes for each of text.
        step = max(1, int(len(batch) * (4 << 20) / max(1, batch.nbytes)))
        for at in range(0, len(batch), step):
            held.append(batch.slice(at, step))
            table = pa.Table.from_batches(held).combine_chunks()
            rows = table.to_batches()[0] if len(table) else None
            if rows is None:
                continue
            conv = rows.column("conv_id")
            conv_values = conv.to_pylist()
            cut = len(conv_values)
            while cut and conv_values[cut - 1] == conv_values[-1]:
                cut -= 1
            if cut:
                yield flush(rows.slice(0, cut))
            rest = rows.slice(cut)
            if rest.nbytes > PART_BYTES:
                yield flush(rest)
                held = []
            else:
                held = [rest]
    if held and len(held[0]):
        yield flush(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


def format_conversations(turns: DataFrame) -> DataFrame:
    """Formatted text and loss mask per conversation of ``turns`` (conv_id, turn, role, text).

    Returns conv_id, part, text and the code point spans loss_starts, loss_ends of
    the assistants' texts. Null role and text count as empty, rows of a null
    conv_id form one conversation, equal turns are ordered by role and text. A
    conversation above ``PART_BYTES`` comes in parts of whole turns, in order and
    in one partition. An empty table gives no rows. Other columns are ignored.
    """
    rows = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(_format, FORMATTED)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, state, done = (), None, []

    def close() -> None:
        turns, turn_hash, loss, loss_hash, chars = state
        done.append((current[0], turns, turn_hash.hexdigest(), loss, loss_hash.hexdigest(), chars))

    def rows() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        made = pa.record_batch([pa.array(list(c), k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names)
        done.clear()
        return made

    for batch in batches:
        for row in batch.to_pylist():
            if current != (row["conv_id"],):
                if state:
                    close()
                current, state = (row["conv_id"],), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            text = row["text"]
            for role, content in _TURN.findall(text):
                state[0] += 1
                state[1].update(f"{_unescape_role(role)}\n{unescape(content)}\n".encode())
            for start, end in zip(row["loss_starts"], row["loss_ends"], strict=True):
                said = unescape(text[start:end])
                state[2] += len(said)
                state[3].update(said.encode())
            state[4] += len(text)
        if done:
            yield rows()
    if state:
        close()
        yield rows()


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests per conversation, taken only from the formatted text and its loss mask.

    Expects the rows of ``format_conversations`` in their order: parts of a
    conversation follow each other in one partition.
    """
    return formatted.mapInArrow(
        _digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
