"""Chat formatting: turns assembled column by column into one byte buffer."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import bounded_batches

# The template. A turn is BEGIN role \n text END \n; the text of turns with
# the role LEARNED is under the loss mask.
BEGIN, END, LEARNED = "<|im_start|>", "<|im_end|>", "assistant"

# Every control string begins with "<|", "</", "[INST" or "[/INST", or is "<s>". A backslash
# after its first character breaks it; backslashes there are doubled in number first, so
# that taking one away gives the text back.
_ESCAPE = r"([<\[])(\\*)(?=\||/s>|s>|INST\]|/INST\])"
_UNESCAPE = re.compile(r"([<\[])\\(\\*)(?=\||/s>|s>|INST\]|/INST\])")


def escaped(column):
    """No control string is left in the text; ``unescape`` gives it back."""
    return F.regexp_replace(column, _ESCAPE, r"$1\\$2")


def escaped_role(column):
    """As ``escaped``, and on one line."""
    return F.replace(
        F.replace(escaped(column), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")
    )


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def unescape_role(text: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text))


def assemble(columns: list[pa.Array | bytes], rows: int) -> pa.Array:
    """Row by row the concatenation of all columns, as one binary Arrow array.

    Lengths of all segments give their offsets by one cumulative sum; each column is then
    copied by one scatter into the buffer, which is allocated once. ``bytes`` stand for a
    column of equal values.
    """
    lengths = np.empty((rows, len(columns)), np.int64)
    for i, column in enumerate(columns):
        lengths[:, i] = len(column) if isinstance(column, bytes) else np.diff(_offsets(column))
    ends = np.cumsum(lengths.ravel())
    starts = (ends - lengths.ravel()).reshape(lengths.shape)
    buffer = np.empty(int(ends[-1]) if rows else 0, np.uint8)
    for i, column in enumerate(columns):
        if isinstance(column, bytes):
            index = (starts[:, i, None] + np.arange(len(column))).ravel()
            buffer[index] = np.tile(np.frombuffer(column, np.uint8), rows)
            continue
        offsets = _offsets(column)
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        shift = np.repeat(starts[:, i] - (offsets[:-1] - offsets[0]), lengths[:, i])
        buffer[np.arange(len(data)) + shift] = data
    bounds = np.concatenate([[0], ends[len(columns) - 1 :: len(columns)]]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), rows, [None, pa.py_buffer(bounds), pa.py_buffer(buffer)]
    )


def _offsets(column: pa.Array) -> np.ndarray:
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], wide)[column.offset : column.offset + len(column) + 1]


def _filled(column: pa.Array) -> pa.Array:
    """Texts as bytes, null as the empty text."""
    return column.cast(pa.large_string()).fill_null("").cast(pa.large_binary())


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        role, text = (_filled(batch.column(name)) for name in ("role", "text"))
        learned = pa.compute.equal(role, LEARNED.encode())
        head = len(BEGIN) + 1
        begins = np.diff(_offsets(role)) + head
        formatted = assemble(
            [BEGIN.encode(), role, b"\n", text, END.encode(), b"\n"], batch.num_rows
        )
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"),
                batch.column("turn"),
                batch.column("tie"),
                formatted.cast(pa.binary()),
                pa.array(np.where(learned, begins, 0)),
                pa.array(np.where(learned, begins + np.diff(_offsets(text)), 0)),
            ],
            names=["conv_id", "turn", "tie", "formatted", "mask_begin", "mask_end"],
        )


def formatted_turns(conversations: DataFrame) -> DataFrame:
    """Per turn (``conv_id``, ``turn``) its ``formatted`` bytes and the loss mask in them.

    The bytes from ``mask_begin`` up to ``mask_end`` are learned, none where both are 0. A
    conversation is the concatenation of its turns by ``turn`` (null first), then ``tie``.
    Turns are formatted where they are read, whatever conversation they belong to. Null
    roles and texts are empty, repeated rows are turns of their own.
    """
    bounded_batches(conversations.sparkSession)
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.md5(F.concat_ws("\n", role, text).cast("binary")).alias("tie"),
        escaped_role(role).alias("role"),
        escaped(text).alias("text"),
    )
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.mapInArrow(
        _format,
        f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, tie string, formatted binary, "
        "mask_begin bigint, mask_end bigint",
    )


_TURN = re.compile(
    re.escape(BEGIN) + r"(.*?)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL
)


class _Conversation:
    """What is read back from a conversation's formatted turns, one after the other."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: bytes, begin: int, end: int) -> None:
        text = formatted.decode()
        self.chars += len(text)
        for turn in _TURN.finditer(text):
            self.turns += 1
            self.all.update(f"{unescape_role(turn[1])}\n{unescape(turn[2])}\n".encode())
        learned = unescape(formatted[begin:end].decode())
        self.loss_chars += len(learned)
        self.loss.update(learned.encode())

    def row(self) -> tuple:
        return (
            self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars,
            self.loss.hexdigest(), self.chars,
        )


_COLUMNS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, kind = None, None

    def out(rows):
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows), [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()])]
        return pa.RecordBatch.from_arrays(arrays, names=_COLUMNS)

    for batch in batches:
        done, kind = [], batch.schema.field("conv_id").type
        for conv_id, formatted, begin, end in zip(
            *(batch.column(n).to_pylist() for n in ("conv_id", "formatted", "mask_begin", "mask_end"))
        ):
            if current is None or current.conv_id != conv_id:
                if current is not None:
                    done.append(current.row())
                current = _Conversation(conv_id)
            current.add(formatted, begin, end)
        if done:
            yield out(done)
    if current is not None:
        yield out([current.row()])


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation what its formatted turns hold, read back from them.

    A digest runs over a conversation's turns in order, so they are sorted and streamed
    through one task: it holds one batch and the running digests, however long the
    conversation is.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "tie")
    return ordered.select("conv_id", "formatted", "mask_begin", "mask_end").mapInArrow(
        _read_back,
        f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint",
    )
