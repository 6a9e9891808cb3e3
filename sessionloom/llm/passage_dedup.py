"""Passage dedup by prefix-free parsing: every byte of a ``span``-byte string that also starts
anywhere else, in any document or the same one, is removed.

1. Phrases. A rolling hash cuts every document into phrases. Buckets of the phrase hash tell
   each block which of its phrases exist elsewhere and which are common. A string that holds a
   phrase found once in the corpus cannot repeat, which settles most of the text.
2. Order. Of what is left, consecutive strings with the same least phrase travel as one piece
   to that phrase's bucket (common phrases last, so that a passage in a third of all documents
   is met as equal pieces inside and by its rare neighbours at its ends). Strings without a
   whole phrase go by their least rolling hash. Each bucket drops equal pieces, parses the
   rest, and combines the suffix arrays of dictionary and parse into the order of its strings
   (``prefix_free``); neighbours are compared byte by byte.
3. Blocks mark the repeated strings and cut what they cover.

Hashes only decide where strings meet and which cannot repeat; what is removed was compared.
A null text is empty; strings never cross documents; repeated rows count as documents of their
own; texts shorter than ``span`` lose nothing; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sessionloom.llm.blocks import OWN, answered, blocks_of, finished, sent, sent_on, shuffled, steady
from sessionloom.llm.common import text_bytes
from sessionloom.llm.prefix_free import SPACING, TRIGGER, repeated, triggers
from sessionloom.llm.textscan import (
    AT_ONCE,
    covered,
    gathered,
    mixed,
    prefix_hash,
    range_hash,
    sliding_min,
)

SPAN = 200
# A phrase in more blocks than this is common.
COMMON_BLOCKS = 32
PHRASE_BUCKET_BYTES = 4 << 20
PIECE_BUCKET_BYTES = 6 << 20
# Text whose phrases are held, at some 30 times its size.
HELD_BYTES = 6 << 20
_COMMON = np.uint64(1 << 63)

RESULT = (
    "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_text string, "
    "kept_sha256 string"
)


class Phrases:
    """Phrases of some documents: between two triggers of one document, both included."""

    def __init__(self, texts: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        self.stops = np.cumsum(sizes)
        self.sizes = sizes
        self.sums = prefix_hash(self.data)
        found = np.flatnonzero(triggers(self.sums))
        owner = np.searchsorted(self.stops, found, side="right")
        inside = found + TRIGGER <= self.stops[owner] if len(found) else np.zeros(0, bool)
        self.at, owner = found[inside], owner[inside]
        # A phrase per trigger but the last of a document; the others stand for none.
        self.whole = np.append(owner[1:] == owner[:-1], False)[: len(self.at)]
        begin = self.at[self.whole]
        end = self.at[np.flatnonzero(self.whole) + 1] + TRIGGER
        self.hashes = range_hash(self.sums, begin, end) >> np.uint64(1)


def _runs(texts: list[bytes], span: int) -> Iterator[tuple[int, int, Phrases]]:
    """(where it begins among all bytes, places it stands for, phrases) of runs of texts. A long
    text comes in windows that overlap by less than a string: each string is whole in the one
    its place is in, with all phrases inside it."""
    offset = 0
    for _, some in gathered(texts):
        size = sum(map(len, some))
        if size <= 2 * AT_ONCE:
            yield offset, size, Phrases(some)
        else:
            for one in some:
                for a in range(0, len(one), AT_ONCE):
                    window = one[a : a + AT_ONCE + span - 1]
                    yield offset + a, min(AT_ONCE, len(one) - a), Phrases([window])
                offset += len(one)
            continue
        offset += size


def _held_runs(texts: list[bytes], span: int) -> Callable[[], Iterable[tuple[int, int, Phrases]]]:
    """Runs to go through more than once: held, or made anew where a long text has too many."""
    if sum(map(len, texts)) > HELD_BYTES:
        return lambda: _runs(texts, span)
    held = list(_runs(texts, span))
    return lambda: held


def _directory(hashes: np.ndarray, buckets: int):
    """Distinct hashes by (bucket, rest): (hashes, rest as 32 bits, bounds, bucket numbers)."""
    bucket = hashes % np.uint64(buckets)
    rest = (hashes // np.uint64(buckets)).astype(np.uint32)
    order = np.lexsort((rest, bucket))
    bucket = bucket[order].astype(np.int64)
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    bounds = [0, *cuts.tolist(), len(order)] if len(order) else [0]
    return hashes[order], rest[order], bounds, bucket[bounds[:-1]].tolist()


def _send_phrases(buckets: int, span: int):
    def send(columns: tuple) -> list[tuple[int, object]]:
        found = [phrases.hashes for _, _, phrases in _runs(columns[2], span)]
        hashes = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]))
        _, rest, bounds, numbers = _directory(hashes, buckets)
        out = []
        for bucket, a, b in zip(numbers, bounds[:-1], bounds[1:], strict=True):
            # Sorted numbers pack better as differences.
            out.append((bucket, np.diff(rest[a:b], prepend=np.uint32(0)).astype("<u4").tobytes()))
        return out

    return send


def _answer_phrases(_: int, messages: list) -> list:
    """For each phrase sent: 0 found in one block, 1 in several, 2 in many."""
    rests = [np.cumsum(np.frombuffer(m, "<u4"), dtype=np.uint32) for m in messages]
    values, inverse, counts = np.unique(
        np.concatenate(rests), return_inverse=True, return_counts=True
    )
    kind = (counts > 1).astype(np.uint8) + (counts > COMMON_BLOCKS)
    cuts = np.cumsum([len(r) for r in rests])[:-1]
    return [k.tobytes() if k.any() else None for k in np.split(kind[inverse].astype(np.uint8), cuts)]


def _range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of values[lo:hi] for each pair, none empty."""
    levels = [values]
    width = 1
    longest = int((hi - lo).max(initial=1))
    while 2 * width <= longest:
        levels.append(np.minimum(levels[-1][:-width], levels[-1][width:]))
        width *= 2
    level = np.frexp((hi - lo).astype(float))[1] - 1
    out = np.empty(len(lo), values.dtype)
    for k, minima in enumerate(levels):
        mine = level == k
        out[mine] = np.minimum(minima[lo[mine]], minima[hi[mine] - (1 << k)])
    return out


def _keys(phrases: Phrases, kind: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(may repeat, key) of the string of ``span`` bytes at each place."""
    n = len(phrases.data)
    fits = np.zeros(n, bool)
    key = np.zeros(n, np.uint64)
    starts = n - span + 1
    if starts <= 0:
        return fits, key
    stop = np.repeat(phrases.stops, phrases.sizes)
    fits = np.arange(n) + span <= stop
    before = np.zeros(n + 2, np.int64)
    before[phrases.at + 1] = 1
    before = np.cumsum(before)
    # Phrase j lies inside if both its triggers do.
    lo = before[:starts]
    hi = before[span - TRIGGER + 1 : span - TRIGGER + 1 + starts] - 1
    change = np.flatnonzero((np.diff(lo) != 0) | (np.diff(hi) != 0)) + 1
    first = np.concatenate(([0], change))
    length = np.diff(np.append(first, starts))
    lo, hi = lo[first], hi[first]
    value = np.full(len(phrases.at), np.uint64((1 << 64) - 1))
    value[phrases.whole] = phrases.hashes | np.where(kind == 2, _COMMON, np.uint64(0))
    single = np.zeros(len(phrases.at) + 1, np.int64)
    single[1:][phrases.whole] = kind == 0
    single = np.cumsum(single)
    some = hi > lo
    may = np.ones(len(first), bool)
    may[some] = single[hi[some]] == single[lo[some]]
    segment_key = np.zeros(len(first), np.uint64)
    wanted = some & may
    segment_key[wanted] = _range_min(value, lo[wanted], hi[wanted])
    key[:starts] = np.repeat(segment_key, length)
    ok = np.repeat(may, length)
    # No whole phrase: the least hash of the runs of bytes in the string.
    bare = np.repeat(~some, length) & fits[:starts]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], bare.astype(np.int8), [0]))))
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        at = np.arange(a, b + span - TRIGGER)
        grams = range_hash(phrases.sums, at, at + TRIGGER)
        key[a:b] = sliding_min(grams, span - TRIGGER + 1)
    fits[:starts] &= ok
    return fits, key


def _send_pieces(phrase_buckets: int, piece_buckets: int, span: int):
    def send(columns: tuple, answers: dict[int, object]) -> list[tuple[int, object]]:
        runs = _held_runs(columns[2], span)
        found = [phrases.hashes for _, _, phrases in runs()]
        every = np.concatenate([np.zeros(0, np.uint64), *found])
        distinct, local = np.unique(every, return_counts=True)
        hashes, _, bounds, numbers = _directory(distinct, phrase_buckets)
        kind = np.zeros(len(hashes), np.uint8)
        for bucket, a, b in zip(numbers, bounds[:-1], bounds[1:], strict=True):
            if bucket in answers:
                kind[a:b] = np.frombuffer(answers[bucket], np.uint8)
        by_value = np.argsort(hashes)
        kind = np.maximum(kind[by_value], local > 1)
        starts, counts, keys, numbers_of = [], [], [], []
        strings: dict[bytes, int] = {}
        for offset, places, run in runs():
            may, key = _keys(run, kind[np.searchsorted(distinct, run.hashes)], span)
            may[places:] = False
            new = may.copy()
            doc_start = np.zeros(len(may) + 1, bool)
            doc_start[run.stops] = True
            new[1:] &= ~may[:-1] | (key[1:] != key[:-1]) | doc_start[1:-1]
            first = np.flatnonzero(new)
            goes_on = np.append(may[1:] & ~new[1:], False)[: len(may)]
            count = np.flatnonzero(may & ~goes_on) + 1 - first
            body = run.data.tobytes()
            stop = (first + count + span - 1).tolist()
            numbers_of += [
                strings.setdefault(body[a:b], len(strings))
                for a, b in zip(first.tolist(), stop, strict=True)
            ]
            starts.append(first + offset)
            counts.append(count)
            keys.append(key[first])
        of = np.array(numbers_of, np.int64)
        none = np.zeros(0, np.int64)
        start, count = np.concatenate([none, *starts]), np.concatenate([none, *counts])
        key = np.concatenate([np.zeros(0, np.uint64), *keys])
        times = np.bincount(of, minlength=len(strings))
        string_key = np.zeros(len(strings), np.uint64)
        string_key[of] = key
        bucket = (mixed(string_key) % np.uint64(piece_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        texts = list(strings)
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        bounds = [0, *cuts.tolist(), len(order)] if len(order) else [0]
        names = bucket[order][bounds[:-1]].tolist()
        out: list[tuple[int, object]] = []
        for name, a, b in zip(names, bounds[:-1], bounds[1:], strict=True):
            mine = [texts[i] for i in order[a:b].tolist()]
            sizes = np.fromiter(map(len, mine), "<i4", len(mine)).tobytes()
            twice = (times[order[a:b]] > 1).tobytes()
            out.append((name, (sizes, twice, b"".join(mine))))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        note = tuple(x.astype("<i4").tobytes() for x in (start, count, rank[of]))
        return [*out, (OWN, (*note, names, bounds))]

    return send


def _answer_pieces(span: int):
    """For each piece sent, packed bits: does the string at each of its places repeat."""

    def answer(_: int, messages: list) -> list:
        numbers: dict[bytes, int] = {}
        times: list[int] = []
        sent_pieces = []
        for sizes, twice, body in messages:
            mine, at = [], 0
            for size, often in zip(
                np.frombuffer(sizes, "<i4").tolist(), np.frombuffer(twice, bool).tolist(), strict=True
            ):
                number = numbers.setdefault(body[at : at + size], len(numbers))
                at += size
                if number == len(times):
                    times.append(0)
                times[number] += 1 + often
                mine.append(number)
            sent_pieces.append(mine)
        strings = list(numbers)
        bits = repeated(strings, span)
        counts = np.fromiter((len(s) - span + 1 for s in strings), np.int64, len(strings))
        bits |= np.repeat(np.array(times) > 1, counts)
        stops = np.cumsum(counts).tolist()
        parts = [bits[b - c : b] for b, c in zip(stops, counts.tolist(), strict=True)]
        out = []
        for mine in sent_pieces:
            told = np.concatenate([parts[i] for i in mine])
            out.append(np.packbits(told).tobytes() if told.any() else None)
        return out

    return answer


def _finish(span: int, with_text: bool):
    def finish(columns: tuple, answers: dict[int, object]) -> pa.Table:
        body = b"".join(columns[2])
        data = np.frombuffer(body, np.uint8)
        *arrays, names, bounds = answers[OWN]
        start, count, rank = (np.frombuffer(a, "<i4").astype(np.int64) for a in arrays)
        # Places of each string sent, in the order sent.
        size = np.zeros(bounds[-1], np.int64)
        size[rank] = count
        base = np.cumsum(size) - size
        bits = np.zeros(int(size.sum()), bool)
        for name, a, b in zip(names, bounds[:-1], bounds[1:], strict=True):
            if name in answers:
                n = int(size[a:b].sum())
                told = np.unpackbits(np.frombuffer(answers[name], np.uint8), count=n)
                bits[base[a] : base[a] + n] = told.astype(bool)
        step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        place = (np.repeat(start, count) + step)[bits[np.repeat(base[rank], count) + step]]
        gone = covered(place, span, len(data))
        sizes = np.fromiter(map(len, columns[2]), np.int64, len(columns[2]))
        stops = np.cumsum(sizes)
        begins = stops - sizes
        before = np.concatenate(([0], np.cumsum(gone)))
        removed = before[stops] - before[begins]
        rise = gone.copy()
        rise[1:] &= ~gone[:-1]
        rise[begins[sizes > 0]] = gone[begins[sizes > 0]]
        risen = np.concatenate(([0], np.cumsum(rise)))
        kept = data[~gone].tobytes()
        kept_stop = (stops - before[stops]).tolist()
        texts = [kept[a:b] for a, b in zip([0, *kept_stop[:-1]], kept_stop, strict=True)]
        return pa.table(
            {
                "doc_id": pa.array(columns[0], pa.int64(), mask=np.array(columns[1], bool)),
                "n_bytes": sizes,
                "n_removed": removed,
                "n_spans": risen[stops] - risen[begins],
                "kept_text": pa.array(
                    [t.decode("utf-8", "replace") if with_text else None for t in texts], pa.string()
                ),
                "kept_sha256": [hashlib.sha256(t).hexdigest() for t in texts],
            }
        )

    return finish


def dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    span: int = SPAN,
    with_text: bool = True,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_text (null if not asked
    for; a cut inside a character leaves a replacement character), kept_sha256."""
    if span < 2 * TRIGGER:
        raise ValueError(f"span must be at least {2 * TRIGGER} bytes")
    size = text_bytes(docs, text)
    phrase_buckets = max(1, -(-4 * size // (SPACING * PHRASE_BUCKET_BYTES)))
    piece_buckets = max(1, -(-3 * size // PIECE_BUCKET_BYTES))
    blocks = shuffled(steady(blocks_of(docs, doc_id, text)))
    kinds = answered(sent(blocks, _send_phrases(phrase_buckets, span)), _answer_phrases)
    pieces = sent_on(blocks, kinds, _send_pieces(phrase_buckets, piece_buckets, span))
    answers = answered(pieces, _answer_pieces(span))
    return finished(blocks, answers, _finish(span, with_text), RESULT)
