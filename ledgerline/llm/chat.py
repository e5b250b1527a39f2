"""Chat formatting by columnar byte assembly.

A turn becomes ``<|im_start|>role<|im_sep|>text<|im_end|>``. Inside roles and texts a control string cannot occur: a backslash
is put after every ``<`` that is followed by any number of backslashes and ``|``, and taken out again on reading.

Turns are dealt out by ranges of (conversation, turn), so a conversation with very many turns spreads over tasks. Each task
computes the length of every segment, cumulates offsets, and copies headers and contents to their indices in one preallocated
buffer, which becomes the Arrow column as it is. A long conversation comes in several parts, to be read in order.
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

from ledgerline.llm.common import prepare, slices
from ledgerline.llm.pieces import ragged

START, MIDDLE, END = b"<|im_start|>", b"<|im_sep|>", b"<|im_end|>"
TRAINED_ROLE = b"assistant"
#: Bytes after which a conversation goes on in another part.
PART_BYTES = 1 << 16

_ORDER = ["turn", "role", "tie", "seq"]
_escaped = re.compile(rb"<\\(\\*)\|")


def unescape(value: bytes) -> bytes:
    return _escaped.sub(rb"<\1|", value)


def parse(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """Role and text of each turn of a part."""
    turns = (turn.removeprefix(START).split(MIDDLE, 1) for turn in formatted.split(END)[:-1])
    return [(unescape(role), unescape(text)) for role, text in turns]


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a column without nulls, and where each value begins and the last ends."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def _escape(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bars = np.flatnonzero(data == ord("|"))
    bars = bars[bars > 0]
    if not len(bars):
        return data, offsets
    last = np.maximum.accumulate(np.where(data != ord("\\"), np.arange(len(data)), -1))
    opening = last[bars - 1]
    begin = offsets[np.searchsorted(offsets, bars, side="right") - 1]
    fits = opening >= begin
    fits[fits] = data[opening[fits]] == ord("<")
    places = opening[fits] + 1
    return np.insert(data, places, ord("\\")), offsets + np.searchsorted(places, offsets, side="left")


def assemble(roles: pa.Array, texts: pa.Array, parts: np.ndarray) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Formatted parts, their loss spans in code points, and turns per part. ``parts``: row at which each part begins."""
    raw_role, raw_ends = _flat(roles)
    role, role_at = _escape(raw_role, raw_ends)
    text, text_at = _escape(*_flat(texts))
    role_long, text_long = np.diff(role_at), np.diff(text_at)
    long = len(START) + role_long + len(MIDDLE) + text_long + len(END)
    at = np.concatenate(([0], np.cumsum(long)))
    buffer = np.empty(int(at[-1]), np.uint8)

    def put(places: np.ndarray, value: bytes) -> None:
        buffer[places[:, None] + np.arange(len(value))] = np.frombuffer(value, np.uint8)

    role_begin = at[:-1] + len(START)
    text_begin = role_begin + role_long + len(MIDDLE)
    put(at[:-1], START)
    buffer[ragged(role_begin, role_long)] = role
    put(role_begin + role_long, MIDDLE)
    buffer[ragged(text_begin, text_long)] = text
    put(text_begin + text_long, END)

    trained = np.flatnonzero([r == TRAINED_ROLE.decode() for r in roles.to_pylist()])
    chars = np.concatenate(([0], np.cumsum((buffer & 0xC0) != 0x80)))
    owner = np.searchsorted(parts, trained, side="right") - 1
    base = chars[at[parts[owner]]]
    spans = pa.StructArray.from_arrays(
        [pa.array((chars[text_begin[trained]] - base).astype(np.int32)),
         pa.array((chars[text_begin[trained] + text_long[trained]] - base).astype(np.int32))], ["start", "end"],
    )
    ends = np.append(parts, len(long))
    loss = pa.ListArray.from_arrays(pa.array(np.searchsorted(trained, ends).astype(np.int32)), spans)
    offsets = at[ends].astype(np.int32)
    formatted = pa.Array.from_buffers(pa.string(), len(parts), [None, pa.py_buffer(offsets), pa.py_buffer(buffer)])
    return formatted, loss, np.diff(ends)


def _begins(batch: pa.RecordBatch) -> np.ndarray:
    """Rows at which a part begins: another conversation, or enough bytes."""
    ids = batch.column("conv_id")
    known, values = ids.is_valid().to_numpy(zero_copy_only=False), pc.fill_null(ids, 0).to_numpy()
    new = np.append(True, (values[1:] != values[:-1]) | (known[1:] != known[:-1]))
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy().astype(np.int64)
    before = np.cumsum(sizes) - sizes
    run = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    block = (before - before[run]) // PART_BYTES
    return np.flatnonzero(new | np.append(False, block[1:] != block[:-1]))


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seq = 0
    for batch in batches:
        for some in slices(batch, "text"):
            begins = _begins(some)
            formatted, loss, n_turns = assemble(some.column("role"), some.column("text"), begins)
            firsts = some.take(pa.array(begins))
            yield pa.RecordBatch.from_arrays(
                [firsts.column("conv_id"), firsts.column("turn"), firsts.column("role"), firsts.column("tie"),
                 pa.array(np.arange(seq, seq + len(begins))), pa.array(n_turns.astype(np.int64)), formatted, loss],
                ["conv_id", *_ORDER, "n_turns", "formatted", "loss"],
            )
            seq += len(begins)


def format_chat(turns: DataFrame) -> DataFrame:
    """Conversations as text, one row per part: ``conv_id``, the order keys ``turn, role, tie, seq`` of the part, ``n_turns``,
    ``formatted``, and ``loss``: spans of code points (end exclusive) that hold assistant texts.

    Turns are taken by ``turn``, ties by role, then by a hash of role and text; null turns come first. A null role or text is
    empty. Turns without a conversation id make up one conversation without an id; repeated turns are all kept. Only a role that
    is exactly ``assistant`` is under the loss mask.
    """
    prepare(turns.sparkSession)
    blank = F.lit("")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"), F.coalesce(F.col("text").cast("string"), blank).alias("text"),
    ).withColumn("tie", F.xxhash64("role", "text"))
    keys = ["conv_id", "turn", "role", "tie"]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys, "text")
    return dealt.mapInArrow(
        _format, "conv_id long, turn long, role string, tie long, seq long, n_turns long, formatted string, "
        "loss array<struct<start: int, end: int>>"
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of one conversation after the other, from parts in order; holds one batch at a time."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    current, state = None, None

    def row():
        return [current[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]]

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    for batch in batches:
        done = []
        for conv, formatted, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss"))):
            if current != (conv,):
                if current:
                    done.append(row())
                current, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parse(formatted.encode()):
                state[0] += 1
                state[1].update(role + b"\n" + text + b"\n")
            for span in loss:
                masked = unescape(formatted[span["start"] : span["end"]].encode())
                state[2] += len(masked.decode())
                state[3].update(masked)
            state[4] += len(formatted)
        if done:
            yield out(done)
    if current:
        yield out([row()])


def read_back(parts: DataFrame) -> DataFrame:
    """What the formatted parts say of each conversation: turns, digest of roles and texts, text under the loss mask, length."""
    prepare(parts.sparkSession)
    dealt = parts.repartition("conv_id").sortWithinPartitions("conv_id", *_ORDER)
    return dealt.select("conv_id", "formatted", "loss").mapInArrow(
        _read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
