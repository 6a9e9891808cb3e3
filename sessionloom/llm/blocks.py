"""Blocks of documents that exchange messages with buckets.

Some questions need equal pieces of text from all documents to meet. Documents are packed into
blocks of a few MB; a block sends each bucket one compressed message with the distinct pieces
that belong there, and the bucket answers each block. A block therefore sends a piece once
however many copies it holds, so a bucket gets at most one row per block and distinct piece,
and all that is said per copy stays inside its block.

Blocks are built inside a scan task, in its row order, and travel compressed through one
shuffle that all steps of a query share. A lost one is built again from the same file range.
Answers belong to the very documents they were asked for: every block notes a digest of its
documents when it sends, and a block whose digest is not the one noted (its table was split
anew in between) ends the job with an error instead of a wrong result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.common import checkpointed, packed, release, releasing, unpacked

BLOCK_BYTES = 4 << 20
BLOCKS = "block bigint, payload binary"
MESSAGES = "bucket bigint, block bigint, payload binary"

# Rows of a bucket's own, beside its answers: their block numbers are TOTAL and below.
TOTAL = -2
# Stands for a null id: larger than all others.
NO_ID = (1 << 63) - 1
OWN = -1


def blocks_of(docs: DataFrame, doc_id: str, text: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, payload): ids and UTF-8 texts of the documents, sorted by id, a null id last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        number = size = 0
        held: list[tuple[int, bool, bytes]] = []
        for batch in batches:
            texts = batch["text"].cast(pa.binary()).to_pylist()
            for doc, body in zip(batch["doc_id"].to_pylist(), texts, strict=True):
                held.append((NO_ID if doc is None else doc, doc is None, body or b""))
                size += len(body or b"") + 16
                if size >= block_bytes:
                    yield _block(first + number, held)
                    held, size, number = [], 0, number + 1
        if held:
            yield _block(first + number, held)

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    return rows.mapInArrow(releasing(run), BLOCKS)


def steady(blocks: DataFrame) -> DataFrame:
    """Blocks that are the same whenever a lost one is made again. Those of a plain scan are; rows
    that were shuffled before may come in another order, so their blocks are checkpointed."""
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    return checkpointed(blocks) if "Exchange" in plan else blocks


def _block(number: int, held: list[tuple[int, bool, bytes]]) -> pa.RecordBatch:
    held.sort(key=lambda row: row[:2])
    columns = tuple([row[i] for row in held] for i in range(3))
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), pa.array([packed(columns)], pa.binary())],
        ["block", "payload"],
    )


def shuffled(blocks: DataFrame) -> DataFrame:
    """Blocks dealt by number, so that answers can come to them. Every step of a query that
    begins here reads the same shuffle."""
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks.repartition(n, "block")


def message_rows(rows: list[tuple[int, int, object]]) -> pa.Table:
    return pa.Table.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([r[1] for r in rows], pa.int64()),
            pa.array([packed(r[2]) for r in rows], pa.binary()),
        ],
        ["bucket", "block", "payload"],
    )


def _digest(columns: tuple) -> int:
    ids = np.array(columns[0], np.int64).tobytes()
    sizes = np.fromiter(map(len, columns[2]), np.int64, len(columns[2])).tobytes()
    return zlib.crc32(sizes, zlib.crc32(ids))


def _with_note(columns: tuple, out: list[tuple[int, object]], block: int) -> list:
    """Messages of a block with its own number, and its note closed by the digest."""
    note = next((value for bucket, value in out if bucket == OWN), None)
    rows = [(bucket, block, value) for bucket, value in out if bucket != OWN]
    return [*rows, (OWN - block, block, (_digest(columns), note))]


def _checked(columns: tuple, got: dict[int, object]) -> dict[int, object]:
    digest, note = got.get(OWN, (None, None))
    if digest != _digest(columns):
        raise ValueError("answers are for other documents: the table was split anew")
    return {**got, OWN: note}


def sent(blocks: DataFrame, send: Callable[[tuple], list[tuple[int, object]]]) -> DataFrame:
    """Messages of each block: ``send(columns of the block)`` gives (bucket, value) pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload in zip(batch["block"].to_pylist(), batch["payload"], strict=True):
                columns = unpacked(payload.as_py())
                yield from message_rows(_with_note(columns, send(columns), block)).to_batches()

    return blocks.mapInArrow(releasing(run), MESSAGES)


def sent_on(
    blocks: DataFrame,
    answers: DataFrame,
    send: Callable[[tuple, dict[int, object]], list[tuple[int, object]]],
) -> DataFrame:
    """Messages of each block that has got answers: ``send(columns, {bucket: value})``. A
    message to bucket OWN is the block's note to itself."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for payload in left["payload"]:
            columns = unpacked(payload.as_py())
            found = send(columns, _checked(columns, _answers(right)))
            out += _with_note(columns, found, key[0].as_py())
        release()
        return message_rows(out)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, MESSAGES)


def _answers(rows: pa.Table) -> dict[int, object]:
    return {
        max(b, OWN): unpacked(p.as_py())
        for b, p in zip(rows["bucket"].to_pylist(), rows["payload"], strict=True)
    }


def answered(
    messages: DataFrame, answer: Callable[[int, list[object]], list[object]]
) -> DataFrame:
    """One answer per message, or None: ``answer(bucket, values of all its messages)``. Notes
    come back to their blocks as they are."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        bucket, senders = key[0].as_py(), rows["block"].to_pylist()
        if bucket < 0:
            return rows.select(["bucket", "block", "payload"])
        values = answer(bucket, [unpacked(p.as_py()) for p in rows["payload"]])
        kept = [(bucket, s, v) for s, v in zip(senders, values, strict=True) if v is not None]
        release()
        return message_rows(kept)

    return messages.groupBy("bucket").applyInArrow(run, MESSAGES)


def tallied(
    messages: DataFrame,
    tally: Callable[[int, list[object]], tuple[list[object], object]],
    answering: bool = True,
) -> DataFrame:
    """Like ``answered``, with a row of each bucket's own beside its answers: ``tally`` gives both.
    That row's block is TOTAL minus the bucket; without ``answering`` it is the only one."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        bucket, senders = key[0].as_py(), rows["block"].to_pylist()
        if bucket < 0:
            return rows.select(["bucket", "block", "payload"]).slice(0, len(rows) if answering else 0)
        answers, own = tally(bucket, [unpacked(p.as_py()) for p in rows["payload"]])
        out = [(bucket, TOTAL - bucket, own)]
        if answering:
            out += [(bucket, s, a) for s, a in zip(senders, answers, strict=True) if a is not None]
        release()
        return message_rows(out)

    return messages.groupBy("bucket").applyInArrow(run, MESSAGES)


def finished(
    blocks: DataFrame,
    answers: DataFrame,
    finish: Callable[[tuple, dict[int, object]], pa.Table],
    schema: str,
) -> DataFrame:
    """Rows that ``finish(columns, {bucket: answer})`` makes of each block."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        got = _answers(right)
        found = []
        for payload in left["payload"]:
            columns = unpacked(payload.as_py())
            found.append(finish(columns, _checked(columns, got)))
        release()
        return pa.concat_tables(found)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)
