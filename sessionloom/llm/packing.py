"""Packing by best-fit decreasing over a segment tree of remaining capacities.

Documents become token ids with a closing id. Those longer than a sequence are first cut into
full windows; what is left of each is packed into open sequences, longest piece first, into
the sequence with the least room that still takes it. The tree has one leaf per capacity and
finds that sequence in log(size) steps.

Pieces are dealt into groups by a hash, each large enough that its last, badly filled
sequences do not count, and each packed by one task on its own; texts are not shuffled, only
lengths. Defined results: a null text is empty and gives the closing id alone; pieces of equal
length go by id, then place; repeated rows are packed each; an empty table gives an empty one.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.common import releasing

SEQUENCE = 2048
END_ID = 1
# Pieces packed together by one task.
GROUP_PIECES = 20_000
# Distinct words whose ids a Python worker remembers (some 100 MB).
CACHED_WORDS = 500_000
DOCS_AT_ONCE = 256

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids array<int>"
)
PACKED = PIECES.replace(", ids array<int>", ", sequence_id bigint, offset bigint, ids array<int>")

_tokenizers: dict[str, WordTokenizer | TextTokenizer] = {}


class Capacities:
    """Open sequences by remaining room: a segment tree over 0..size of how many there are."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, room: int, change: int) -> None:
        node = self.leaves + room
        while node:
            self.count[node] += change
            node >>= 1

    def put(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._add(room, 1)

    def take(self, room: int) -> tuple[int, int] | None:
        """The sequence with the least room of at least ``room``, as (its room, sequence)."""
        node = self.leaves + room
        if not self.count[node]:
            # Up until a sibling on the right holds something, then down its left edge.
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        found = node - self.leaves
        self._add(found, -1)
        return found, self.open[found].pop()


def best_fit(lengths: list[int], size: int) -> list[tuple[int, int]]:
    """(sequence, offset) of each length; lengths come in decreasing order."""
    tree, places, sequences = Capacities(size), [], 0
    for length in lengths:
        found = tree.take(length)
        if found is None:
            found = (size, sequences)
            sequences += 1
        room, sequence = found
        places.append((sequence, size - room))
        if room > length:
            tree.put(room - length, sequence)
    return places


# Parts that the tokenizer takes one by one from a lower-cased word of plain letters (fixed by
# its file; other words go through the tokenizer whole).
_PLAIN = re.compile(r"[\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
_PARTS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+"
)


# The settings of a tokenizer file that make the above hold.
_WORDWISE = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


class _Words(dict):
    """Number of each word seen; new ones wait in ``fresh`` for their ids."""

    def __init__(self) -> None:
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number


class WordTokenizer:
    """Ids of texts by a tokenizer with the settings ``_WORDWISE``. White space only parts tokens, so
    each distinct word between white space is encoded once and remembered, its parts too."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters: dict[str, str] = {}
        self.special = re.compile("|".join(map(re.escape, added)) or "(?!)")
        self.forget()

    def forget(self) -> None:
        self.words = _Words()
        self.parts: dict[str, tuple[int, ...]] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.stops = np.zeros(1 << 14, np.int64)

    def _new_part(self, part: str) -> tuple[int, ...]:
        letters = self.letters
        for letter in part:
            if letter not in letters:
                # The model's spelling of the bytes of a character.
                found = self.tokenizer.pre_tokenizer.pre_tokenize_str(letter)
                letters[letter] = "".join(spelled for spelled, _ in found)
        spelled = "".join([letters[letter] for letter in part])
        ids = self.parts[part] = tuple([t.id for t in self.tokenizer.model.tokenize(spelled)])
        return ids

    def _encode(self, word: str) -> Sequence[int]:
        special = self.special.search(word)
        if special or not (word.isascii() or _PLAIN.fullmatch(word)):
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        known = self.parts
        parts = _PARTS.findall(word.lower())
        if len(parts) == 1:
            return known.get(parts[0]) or self._new_part(parts[0])
        return [i for part in parts for i in known.get(part) or self._new_part(part)]

    def _learn(self) -> None:
        fresh, done = self.words.fresh, len(self.words) - len(self.words.fresh)
        self.words.fresh = []
        found = [self._encode(w.decode("utf-8", "replace")) for w in fresh]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        at = int(self.stops[done])
        stops = at + np.cumsum(sizes)
        self.stops = _grown(self.stops, len(self.words) + 1)
        self.stops[done + 1 : len(self.words) + 1] = stops
        end = int(stops[-1]) if len(stops) else at
        self.ids = _grown(self.ids, end)
        self.ids[at:end] = np.fromiter(chain.from_iterable(found), np.int32, end - at)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.words) > CACHED_WORDS:
            self.forget()
        # Splitting bytes cuts at ASCII white space alone.
        split = [text.encode("utf-8", "surrogatepass").split() for text in texts]
        number = self.words.__getitem__
        total = sum(map(len, split))
        numbers = np.fromiter(map(number, chain.from_iterable(split)), np.int64, total)
        if self.words.fresh:
            self._learn()
        start = self.stops[numbers]
        size = self.stops[numbers + 1] - start
        stop = np.cumsum(size)
        ids = self.ids[np.repeat(start - (stop - size), size) + np.arange(int(size.sum()))]
        words = np.cumsum([len(w) for w in split])
        ends = np.concatenate(([0], stop))[words]
        return np.split(ids, ends[:-1])


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    out = np.zeros(max(size, 2 * len(array)), array.dtype)
    out[: len(array)] = array
    return out


class TextTokenizer:
    """Ids of texts by any other tokenizer: every text is encoded whole."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(one.ids, np.int32) for one in found]


def _opened(path: str) -> WordTokenizer | TextTokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    settings = json.loads(tokenizer.to_str())
    wordwise = all(settings.get(name) == value for name, value in _WORDWISE.items())
    return WordTokenizer(tokenizer) if wordwise else TextTokenizer(tokenizer)


def token_ids(texts: list[str], path: str) -> list[np.ndarray]:
    if path not in _tokenizers:
        _tokenizers[path] = _opened(path)
    return _tokenizers[path](texts)


def cut(docs: DataFrame, tokenizer_path: str, doc_id: str, text: str, size: int, with_ids: bool) -> DataFrame:
    """One row per piece: full windows of ``size`` ids, then the rest of the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(at, DOCS_AT_ONCE)
                texts = [t or "" for t in part["text"].to_pylist()]
                columns: list[list] = [[] for _ in range(6)]
                ids_of = token_ids(texts, tokenizer_path)
                for doc, ids in zip(part["doc_id"].to_pylist(), ids_of, strict=True):
                    ids = np.append(ids, np.int32(END_ID)).astype("<u4")
                    for start in range(0, len(ids), size):
                        piece = ids[start : start + size]
                        row = (doc, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))
                        for column, value in zip(columns, row, strict=False):
                            column.append(value)
                        columns[5].append(piece.astype(np.int32) if with_ids else None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns[:5]]
                    + [pa.array(columns[5], pa.list_(pa.int32()))],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"],
                )

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    return rows.mapInArrow(releasing(run), PIECES)


def _pack_group(size: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        order = pa.compute.sort_indices(
            rows,
            [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")],
        )
        rows = rows.take(order)
        places = best_fit(rows["length"].to_pylist(), size)
        group = key[0].as_py() << 32
        return (
            rows.drop_columns(["group"])
            .append_column("sequence_id", pa.array([group + s for s, _ in places], pa.int64()))
            .append_column("offset", pa.array([o for _, o in places], pa.int64()))
            .select([f.split()[0] for f in PACKED.split(", ")])
        )

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SEQUENCE,
    with_ids: bool = False,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids
    (null unless asked for)."""
    groups = max(1, -(-docs.count() // group_pieces))
    pieces = cut(docs, tokenizer_path, doc_id, text, size, with_ids)
    # The checksum deals out repeated ids too.
    group = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups))
    return (
        pieces.withColumn("group", group).groupBy("group").applyInArrow(_pack_group(size), PACKED)
    )


def sequences(packed: DataFrame, size: int = SEQUENCE, pad_id: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, input_ids padded to ``size``, pieces) from pieces with ids; a
    sequence holds at most ``size`` ids, so its rows are few."""
    row = F.struct("offset", "doc_id", "start", "length", "ids")
    rows = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(row)).alias("parts"))
    ids = F.flatten(F.col("parts.ids"))
    return rows.select(
        "sequence_id",
        F.size(ids).alias("n_tokens"),
        F.concat(ids, F.array_repeat(F.lit(pad_id), F.lit(size) - F.size(ids))).alias("input_ids"),
        F.transform(
            "parts", lambda p: F.struct(p["doc_id"], p["start"], p["length"], p["offset"])
        ).alias("pieces"),
    )
