"""Fill-in-middle transformation over texts stored as seekable compressed frames.

``framed`` stores each text as a row of independent zstandard frames of at most ``frame_bytes``
bytes. A frame notes how many units (tokens: white space and the word behind it) and how many
code points it adds, so the sums before it say which frame holds the end of unit u. ``cut`` draws
two cuts per document from a hash of its id, decompresses the frames the cuts fall in and no
others, and puts the frames in their new order: a frame without a cut moves as it is. Digests
are made of a stream of frames, one decompressed at a time, and ``restored`` finds the marks in
the output's own stream to put the parts back. Nothing is shuffled.

Defined results: a null text is empty; an empty text and one that holds a mark itself stay plain;
the decimal form of a null id is empty; rows that are repeated are transformed alike, each for
itself; an empty table gives an empty table. Other columns take no part.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.common import releasing
from sessionloom.llm.textscan import is_space

SEED = 42
# Of 100 documents that can be cut so many stay plain; of the others so many begin with the suffix.
PLAIN, SUFFIX_FIRST = 50, 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
FRAME_BYTES = 64 << 10
# Rows handed on at once hold about so many bytes.
BATCH_BYTES = 4 << 20

# ``closes``: the last byte of the frame is the last of a unit.
FRAME = "struct<n_bytes:bigint, units:bigint, chars:bigint, closes:boolean, payload:binary>"
FRAMED = f"doc_id string, n bigint, marked boolean, frames array<{FRAME}>"
CUT = (
    "doc_id string, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
    f"output_sha256 string, restored_sha256 string, frames array<{FRAME}>"
)
Frame = dict


def _ends(data: np.ndarray, closed: bool) -> np.ndarray:
    """Places of the last bytes of units. ``closed``: what follows is white space or nothing."""
    space = is_space(data)
    after = np.append(space[1:], closed)
    return np.flatnonzero(~space & after)


def _frame(data: bytes, units: int, closes: bool) -> Frame:
    codes = np.frombuffer(data, np.uint8)
    return {
        "n_bytes": len(data),
        "units": units,
        "chars": int(np.count_nonzero((codes & 0xC0) != 0x80)),
        "closes": closes,
        "payload": zstandard.ZstdCompressor(level=1).compress(data),
    }


def frames_of(text: bytes, frame_bytes: int = FRAME_BYTES) -> list[Frame]:
    """Frames of one text. White space at its end is a unit of its own."""
    out = []
    for at in range(0, len(text), frame_bytes):
        piece = text[at : at + frame_bytes]
        last = at + frame_bytes >= len(text)
        closed = last or bool(is_space(np.frombuffer(text[at + len(piece) :][:1], np.uint8))[0])
        codes = np.frombuffer(piece, np.uint8)
        ends = _ends(codes, closed)
        units = len(ends)
        closes = units > 0 and int(ends[-1]) == len(piece) - 1
        if last and not closes:
            units, closes = units + 1, True
        out.append(_frame(piece, units, closes))
    return out


def opened(frame: Frame) -> bytes:
    return zstandard.ZstdDecompressor().decompress(frame["payload"], max_output_size=frame["n_bytes"])


def stream(frames: list[Frame], start: int = 0, end: int | None = None) -> Iterator[bytes]:
    """The bytes in [start, end), frame by frame; other frames stay closed."""
    at = 0
    for frame in frames:
        low, high = max(start - at, 0), frame["n_bytes"] if end is None else end - at
        if low < min(high, frame["n_bytes"]):
            yield opened(frame)[low:high]
        at += frame["n_bytes"]


def digest(*streams: Iterator[bytes]) -> str:
    total = hashlib.sha256()
    for pieces in streams:
        for piece in pieces:
            total.update(piece)
    return total.hexdigest()


def split(frames: list[Frame], units: int) -> tuple[list[Frame], list[Frame]]:
    """Frames of the first ``units`` units and of the rest; at most one frame is opened."""
    if units == 0:
        return [], frames
    sums = list(accumulate(frame["units"] for frame in frames))
    hit = bisect_left(sums, units)
    frame, before = frames[hit], sums[hit] - frames[hit]["units"]
    if sums[hit] == units and frame["closes"]:
        return frames[: hit + 1], frames[hit + 1 :]
    data = opened(frame)
    ends = _ends(np.frombuffer(data, np.uint8), frame["closes"])
    # The last unit of a text may be white space, which closes its frame: seen above.
    cut = int(ends[units - before - 1]) + 1
    left = _frame(data[:cut], units - before, True)
    right = _frame(data[cut:], sums[hit] - units, frame["closes"])
    return [*frames[:hit], left], [right, *frames[hit + 1 :]]


def marks(frames: list[Frame], form: str) -> list[int]:
    """Places of the marks in the stream of an output, in the order of its form."""
    places, left = [], list(ORDERS[form])
    tail, at = b"", 0
    for piece in stream(frames):
        data, base, seen = tail + piece, at - len(tail), 0
        while left and (found := data.find(left[0], seen)) >= 0:
            places.append(base + found)
            seen = found + len(left.pop(0))
        at += len(piece)
        # A mark may begin in this frame and end in the next one.
        tail = data[max(seen, len(data) - 2) :]
    return places


def restored(frames: list[Frame], form: str) -> Iterator[bytes]:
    """The text an output was made of, as a stream."""
    if form == "plain":
        yield from stream(frames)
        return
    places = marks(frames, form)
    ends = [*places[1:], sum(frame["n_bytes"] for frame in frames)]
    part = {
        mark: (at + len(mark), end)
        for mark, at, end in zip(ORDERS[form], places, ends, strict=True)
    }
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from stream(frames, *part[mark])


def drawn(doc_id: str, seed: int = SEED) -> list[int]:
    """Four numbers of 32 bits."""
    digits = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


def transformed(doc_id: str, n: int, marked: bool, frames: list[Frame], seed: int = SEED):
    """(form, code points of prefix and middle or None, frames of the output)."""
    first, second, keep, order = drawn(doc_id, seed)
    if not n or marked or keep % 100 >= PLAIN:
        return "plain", None, None, frames
    low, high = sorted((first % (n + 1), second % (n + 1)))
    prefix, rest = split(frames, low)
    middle, suffix = split(rest, high - low)
    parts = {PREFIX: prefix, MIDDLE: middle, SUFFIX: suffix}
    form = "spm" if order % 100 < SUFFIX_FIRST else "psm"
    out = [f for mark in ORDERS[form] for f in (_frame(mark, 0, False), *parts[mark])]
    chars = [sum(frame["chars"] for frame in part) for part in (prefix, middle)]
    return form, *chars, out


def _arrow_type(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def _batches(rows: Iterator[tuple[dict, int]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Record batches of about BATCH_BYTES out of (row, its size)."""
    held, size = [], 0
    for row, more in rows:
        held.append(row)
        size += more + 64
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def framed(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", frame_bytes: int = FRAME_BYTES
) -> DataFrame:
    """(doc_id as text, n, marked, frames): a table worth storing where texts are cut again and
    again. ``marked``: the text holds one of the marks."""
    schema = _arrow_type(FRAMED)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, int]]:
        for batch in batches:
            for number in range(batch.num_rows):
                body = batch["text"][number].as_py() or b""
                frames = frames_of(body, frame_bytes)
                row = {
                    "doc_id": batch["doc_id"][number].as_py(),
                    "n": sum(frame["units"] for frame in frames),
                    "marked": any(mark in body for mark in (PREFIX, SUFFIX, MIDDLE)),
                    "frames": frames,
                }
                yield row, sum(len(frame["payload"]) for frame in frames)

    given = docs.select(
        F.col(doc_id).cast("string").alias("doc_id"),
        F.col(text).cast("string").cast("binary").alias("text"),
    )
    return given.mapInArrow(releasing(lambda batches: _batches(rows(batches), schema)), FRAMED)


def cut(framed_docs: DataFrame, seed: int = SEED, with_frames: bool = True) -> DataFrame:
    """One row per document: doc_id as text, n, form, prefix_chars, middle_chars, output_sha256,
    restored_sha256, frames of the output (null if not asked for; ``stream`` reads them)."""
    schema = _arrow_type(CUT)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, int]]:
        for batch in batches:
            for number in range(batch.num_rows):
                given = {name: batch[name][number].as_py() for name in batch.schema.names}
                form, prefix, middle, out = transformed(
                    given["doc_id"] or "", given["n"], given["marked"], given["frames"], seed
                )
                row = {
                    "doc_id": given["doc_id"],
                    "n": given["n"],
                    "form": form,
                    "prefix_chars": prefix,
                    "middle_chars": middle,
                    "output_sha256": digest(stream(out)),
                    "restored_sha256": digest(restored(out, form)),
                    "frames": out if with_frames else None,
                }
                yield row, sum(len(f["payload"]) for f in out) if with_frames else 256

    return framed_docs.mapInArrow(releasing(lambda batches: _batches(rows(batches), schema)), CUT)
