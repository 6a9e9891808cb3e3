"""Substring dedup by super-k-mers: passages of ``window`` words that start in an earlier
document are removed.

Every window of words has a minimiser, the least of the hashes of its runs of ``run`` words.
Consecutive windows with the same minimiser travel as one packed string to the bucket of that
minimiser; equal windows have equal minimisers, so they meet there, and sorting counts them
exactly: windows with one hash are compared byte by byte.

Hot passages. A block sends equal strings once. Minimisers that are frequent in the whole
corpus, by a fixed table of counters summed over all blocks, come last in the order, so a
window that reaches out of a common passage is routed by a rare run of words, and windows
inside one are equal strings. The order changes where windows meet, never the result.

Defined results: windows of documents with equal ids do not remove each other; a null id
counts as larger than all others; null and empty texts have no words; texts of fewer words
than a window lose nothing; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sessionloom.llm.blocks import answered, blocks_of, finished, sent, shuffled, steady
from sessionloom.llm.common import packed, releasing, text_bytes, unpacked
from sessionloom.llm.textscan import (
    Words,
    covered,
    equal_ranges,
    gathered,
    mixed,
    prefix_hash,
    range_hash,
    sliding_min,
)

WINDOW = 13
RUN = 3
# Text of a bucket aimed at; the number of buckets follows from the size of the corpus.
BUCKET_BYTES = 12 << 20
# Counters of the frequency table; a counter above HOT times the mean marks its runs as hot.
CELLS = 1 << 16
HOT = 8
SLICES = 64

RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, kept_sha256 string"


class Pieces:
    """The super-k-mers of a block, as places in the texts of each run of documents."""

    def __init__(self, texts: list[bytes], window: int, run: int, hot: np.ndarray | None) -> None:
        self.parts: list[Words] = []
        first_word, count, key, doc, part = [], [], [], [], []
        for at, some in gathered(texts):
            words = Words(some)
            n = len(words.starts)
            if n >= window:
                runs = n - run + 1
                sums = prefix_hash(words.data)
                hashes = range_hash(sums, words.starts[:runs], words.ends[run - 1 :]) >> np.uint64(1)
                if hot is not None:
                    late = hot[(hashes % np.uint64(len(hot))).astype(np.int64)]
                    hashes |= late.astype(np.uint64) << np.uint64(63)
                least = sliding_min(hashes, window - run + 1)
                inside = words.doc[: n - window + 1] == words.doc[window - 1 :]
                new = inside.copy()
                new[1:] &= ~inside[:-1] | (least[1:] != least[:-1])
                starts = np.flatnonzero(new)
                # A piece ends where the next begins or where windows cross documents.
                stops = np.flatnonzero(inside & ~np.append(inside[1:] & ~new[1:], False)) + 1
                first_word.append(starts)
                count.append(stops - starts)
                key.append(least[starts] & np.uint64((1 << 63) - 1))
                doc.append(words.doc[starts] + at)
                part.append(np.full(len(starts), len(self.parts)))
            self.parts.append(words)
        none = [np.zeros(0, np.int64)]
        self.first_word = np.concatenate(first_word or none)
        self.count = np.concatenate(count or none)
        self.key = np.concatenate(key or [np.zeros(0, np.uint64)])
        self.doc = np.concatenate(doc or none)
        self.part = np.concatenate(part or none)
        self.window = window

    def strings(self) -> list[bytes]:
        out: list[bytes] = []
        for number, words in enumerate(self.parts):
            mine = self.part == number
            first, last = self.first_word[mine], self.first_word[mine] + self.count[mine]
            text = words.data.tobytes()
            starts = words.starts[first].tolist()
            ends = words.ends[last + self.window - 2].tolist()
            out += [text[a:b] for a, b in zip(starts, ends, strict=True)]
        return out

    def distinct(self) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """(number of each piece's string, first piece of each string, strings)."""
        numbers: dict[bytes, int] = {}
        strings = self.strings()
        of = np.fromiter(
            (numbers.setdefault(s, len(numbers)) for s in strings), np.int64, len(strings)
        )
        first = np.zeros(len(numbers), np.int64)
        first[of[::-1]] = np.arange(len(of))[::-1]
        return of, first, list(numbers)


class Routes:
    """Distinct strings of a block in the order of their buckets.

    A string has one slot per window; ``base`` is the first slot of each string.
    """

    def __init__(self, pieces: Pieces, buckets: int) -> None:
        self.of, self.first, strings = pieces.distinct()
        bucket = (mixed(pieces.key[self.first]) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        self.order, self.strings = order, [strings[i] for i in order.tolist()]
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        self.bounds = [0, *cuts.tolist(), len(order)] if len(order) else [0]
        self.buckets = bucket[order][self.bounds[:-1]].tolist()
        slots = np.concatenate(([0], np.cumsum(pieces.count[self.first][order])))
        self.base = np.empty(len(order), np.int64)
        self.base[order] = slots[:-1]
        self.bucket_base = slots[self.bounds[:-1]]
        self.slots = int(slots[-1])

    def parts(self):
        return zip(self.buckets, self.bounds[:-1], self.bounds[1:], strict=True)


def _ids(columns: tuple) -> np.ndarray:
    return np.array(columns[0], np.int64)


def _send(window: int, run: int, buckets: int, hot: np.ndarray):
    def send(columns: tuple) -> list[tuple[int, object]]:
        pieces = Pieces(columns[2], window, run, hot)
        routes = Routes(pieces, buckets)
        # Documents are sorted by id, so the first piece has the smallest id.
        doc = _ids(columns)[pieces.doc[routes.first][routes.order]].astype("<i8")
        return [
            (bucket, (doc[a:b].tobytes(), b"\n".join(routes.strings[a:b])))
            for bucket, a, b in routes.parts()
        ]

    return send


def least_of_equal(
    data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, doc: np.ndarray
) -> np.ndarray:
    """For each range of ``data`` the smallest ``doc`` of the ranges with the same bytes."""
    tie = np.zeros(len(hashes), np.int64)
    while True:
        order = np.lexsort((tie, hashes)) if tie.any() else np.argsort(hashes, kind="stable")
        x, y = order[:-1], order[1:]
        same = (hashes[x] == hashes[y]) & (tie[x] == tie[y])
        x, y = x[same], y[same]
        equal = sizes[x] == sizes[y]
        equal[equal] = equal_ranges(data, starts[x[equal]], starts[y[equal]], sizes[x[equal]])
        if equal.all():
            break
        # Different bytes with one hash: told apart by the bytes themselves.
        numbers: dict[bytes, int] = {}
        for i in np.flatnonzero(np.isin(hashes, hashes[x[~equal]])).tolist():
            text = data[starts[i] : starts[i] + sizes[i]].tobytes()
            tie[i] = numbers.setdefault(text, len(numbers) + 1)
    begin = np.concatenate(([True], ~same))
    least = np.minimum.reduceat(doc[order], np.flatnonzero(begin))
    out = np.empty_like(doc)
    out[order] = least[np.cumsum(begin) - 1]
    return out


def _answer(window: int):
    """Per message the slots whose window is also in a smaller document than the sender's."""

    def answer(_: int, messages: list) -> list:
        owner = np.concatenate([np.frombuffer(d, "<i8") for d, _ in messages])
        sizes = np.cumsum([0] + [len(d) // 8 for d, _ in messages])
        body, pieces, starts, ends, hashes = [], [], [], [], []
        offset = 0
        for first, some in gathered(text for _, text in messages):
            # Only places and hashes of windows are kept of each run of messages.
            data = np.frombuffer(b"\n".join(some) + b"\n", np.uint8)
            stop = np.flatnonzero((data == 32) | (data == 10))
            start = np.concatenate(([0], stop[:-1] + 1))
            last = data[stop] == 10
            piece = np.cumsum(last) - last
            at = np.flatnonzero(piece[: len(piece) - window + 1] == piece[window - 1 :])
            a, b = start[at], stop[at + window - 1]
            hashes.append(range_hash(prefix_hash(data), a, b))
            pieces.append(piece[at] + sizes[first])
            starts.append(a + offset)
            ends.append(b + offset)
            body.append(data)
            offset += len(data)
        piece = np.concatenate(pieces)
        doc = owner[piece]
        a, b = np.concatenate(starts), np.concatenate(ends)
        least = least_of_equal(np.concatenate(body), a, b - a, np.concatenate(hashes), doc)
        told = np.flatnonzero(least < doc)
        base = np.searchsorted(piece, sizes)
        cuts = np.searchsorted(told, base)
        out: list = []
        for i in range(len(messages)):
            mine = told[cuts[i] : cuts[i + 1]]
            slots = (mine - base[i]).astype("<i4").tobytes()
            out.append((slots, least[mine].astype("<i8").tobytes()) if len(mine) else None)
        return out

    return answer


def _finish(window: int, run: int, buckets: int, hot: np.ndarray, with_text: bool):
    def finish(columns: tuple, answers: dict[int, object]) -> pa.Table:
        pieces = Pieces(columns[2], window, run, hot)
        routes = Routes(pieces, buckets)
        ids = _ids(columns)
        least = np.empty(routes.slots, np.int64)
        least[:] = np.repeat(
            ids[pieces.doc[routes.first][routes.order]], pieces.count[routes.first][routes.order]
        )
        for bucket, base in zip(routes.buckets, routes.bucket_base.tolist(), strict=True):
            if bucket in answers:
                slots, smaller = answers[bucket]
                least[base + np.frombuffer(slots, "<i4")] = np.frombuffer(smaller, "<i8")
        step = np.arange(int(pieces.count.sum())) - np.repeat(
            np.cumsum(pieces.count) - pieces.count, pieces.count
        )
        gone = least[np.repeat(routes.base[routes.of], pieces.count) + step] < np.repeat(
            ids[pieces.doc], pieces.count
        )
        word = (np.repeat(pieces.first_word, pieces.count) + step)[gone]
        part = np.repeat(pieces.part, pieces.count)[gone]
        n_words, n_removed, texts = [], [], []
        for number, words in enumerate(pieces.parts):
            keep = ~covered(word[part == number], window, len(words.starts))
            size = words.ends - words.starts + 1
            body = words.data[np.repeat(keep, size)].tobytes()
            kept = np.bincount(words.doc, size * keep, words.n_docs).astype(np.int64)
            total = words.per_doc()
            n_words += total.tolist()
            n_removed += np.bincount(words.doc, ~keep, words.n_docs).astype(np.int64).tolist()
            stop = np.cumsum(kept).tolist()
            start = [0, *stop[:-1]]
            texts += [body[a : max(a, b - 1)] for a, b in zip(start, stop, strict=True)]
        return pa.table(
            {
                "doc_id": pa.array(columns[0], pa.int64(), mask=np.array(columns[1], bool)),
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "kept_text": pa.array([t.decode("utf-8", "replace") if with_text else None for t in texts], pa.string()),
                "kept_sha256": [hashlib.sha256(t).hexdigest() for t in texts],
            }
        )

    return finish


def hot_cells(blocks: DataFrame, window: int, run: int) -> np.ndarray:
    """Which of CELLS counters hold frequent minimisers. The table's size is fixed; its sums
    cover all documents. Counters add up per task, then per 64th of the table."""

    def count(batches):
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for payload in batch["payload"]:
                key = Pieces(unpacked(payload.as_py())[2], window, run, None).key
                cells = (key % np.uint64(CELLS)).astype(np.int64)
                total += np.bincount(cells, minlength=CELLS)
        for number, part in enumerate(np.split(total, SLICES)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([packed(part)], pa.binary())],
                ["slice", "counts"],
            )

    def add(key: tuple, rows: pa.Table) -> pa.Table:
        total = sum(unpacked(c.as_py()) for c in rows["counts"])
        return pa.table({"slice": [key[0].as_py()], "counts": pa.array([packed(total)], pa.binary())})

    schema = "slice bigint, counts binary"
    rows = blocks.mapInArrow(releasing(count), schema).groupBy("slice").applyInArrow(add, schema).collect()
    total = np.zeros((SLICES, CELLS // SLICES), np.int64)
    for row in rows:
        total[row["slice"]] = unpacked(bytes(row["counts"]))
    return total.ravel() > HOT * max(total.mean(), 1)


def dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    run: int = RUN,
    with_text: bool = True,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (null if not asked for),
    kept_sha256."""
    # Pieces hold about three times the text.
    buckets = max(1, -(-3 * text_bytes(docs, text) // bucket_bytes))
    blocks = steady(blocks_of(docs, doc_id, text))
    hot = hot_cells(blocks, window, run)
    dealt = shuffled(blocks)
    messages = sent(dealt, _send(window, run, buckets, hot))
    answers = answered(messages, _answer(window))
    return finished(dealt, answers, _finish(window, run, buckets, hot, with_text), RESULT)
