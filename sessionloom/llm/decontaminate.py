"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items.

Texts are normalised to words (A-Z lowered, every other ASCII character that is no letter or
digit ends a word). Each run of ``window`` words of an item is a pattern of the automaton, an
item of fewer words is one pattern; each document is scanned once and every word inside an
occurrence is hit. Spans of hit words are reported in code points of the original text.

Defined results: a null text has no words; items without words match nothing; a null item id
reads "null"; repeated items count once; an empty benchmark hits nothing; an empty table gives
an empty table.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from uuid import uuid4

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.llm.common import releasing, stored

WINDOW = 10
# Text of one automaton, which takes up to 200 times as much memory in each Python worker; a
# larger benchmark is cut into several, each scanned in turn.
AUTOMATON_BYTES = 2 << 20

_LOWERED = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)

_built: dict[str, Machine] = {}


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWERED).split()


class Machine:
    """Automaton over words written as a few symbols each, as many as the number of different words
    of the items takes: a pattern has fewer nodes than it has letters. All words have the same
    number of symbols; a match that begins inside one is none."""

    def __init__(self, items: Iterable[tuple[str, str]], window: int) -> None:
        texts = [(item, words(text)) for item, text in items]
        known = list(dict.fromkeys(w for _, found in texts for w in found))
        self.width = max(1, -(-len(known).bit_length() // 8))
        self.symbols = {w: self._written(n) for n, w in enumerate(known, 1)}
        # Not written by any word of the items.
        self.other = self._written(0)
        owners: dict[str, set[str]] = defaultdict(set)
        for item, found in texts:
            line = self._line(found)
            for i in range(max(len(found) - window, 0) + 1 if found else 0):
                owners[line[i * self.width : (i + window) * self.width]].add(item)
        self.sizes = [len(pattern) // self.width for pattern in owners]
        self.owners = [tuple(ids) for ids in owners.values()]
        self.found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for number, pattern in enumerate(owners):
            self.found.add_word(pattern, number)
        self.found.make_automaton()

    def _written(self, number: int) -> str:
        return number.to_bytes(self.width, "little").decode("latin-1")

    def _line(self, found: list[bytes]) -> str:
        symbols, other = self.symbols, self.other
        return "".join([symbols.get(w, other) for w in found])

    def find(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """(words, runs of hit words, ids of the items found)."""
        got = words(text)
        intervals, items = [], set()
        if self.sizes and got:
            for place, number in self.found.iter(self._line(got)):
                end, inside = divmod(place + 1, self.width)
                if not inside:
                    intervals.append((end - self.sizes[number], end - 1))
                    items.update(self.owners[number])
        return len(got), merged(intervals), items


def merged(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint runs of words covered by the intervals (first, last)."""
    runs: list[list[int]] = []
    for first, last in sorted(intervals):
        if runs and first <= runs[-1][1] + 1:
            runs[-1][1] = max(runs[-1][1], last)
        else:
            runs.append([first, last])
    return [(first, last) for first, last in runs]


def original_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code point offsets (start, end) of runs of words in the text as given."""
    if not runs:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    flat = raw.translate(_LOWERED)
    places, at = [], 0
    for word in flat.split():
        at = flat.index(word, at)
        places.append((at, at + len(word)))
        at += len(word)
    spans, done, chars = [], 0, 0
    for first, last in runs:
        out = []
        for byte in (places[first][0], places[last][1]):
            chars += len(raw[done:byte].decode("utf-8", "surrogatepass"))
            done = byte
            out.append(chars)
        spans.append((out[0], out[1]))
    return spans


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """(row struct of the input row, n_words, n_hit, item_ids sorted, spans).

    The items go to the executors in parts measured to hold about ``automaton_bytes`` each.
    The scan needs no shuffle: each automaton adds its hits to what the ones before found.
    """
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"),
        F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("text"),
    ).distinct()
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("item"))).first()[0] or 0
    parts = max(1, -(-int(size) // automaton_bytes))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    state = docs.select(
        F.struct("*").alias("row"),
        F.col(doc_text).cast("string").alias("doc_text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<first:int,last:int>>").alias("hits"),
        F.array().cast("array<string>").alias("items"),
    )
    out_type = state.schema
    found = T.StructType.fromDDL(
        "n_words bigint, n_hit bigint, item_ids array<string>, spans array<struct<start:int,end:int>>"
    )
    closed = T.StructType([state.schema["row"], *found.fields])
    for number in range(parts):
        rows = [(r["item"], r["text"]) for r in items.where(part == number).collect()]
        # The last scan also closes: with one automaton a task needs one Python worker.
        last = number == parts - 1
        run = _scanner(docs.sparkSession, rows, window, last)
        state = state.mapInArrow(releasing(run), closed if last else out_type)
        if not last:
            # Of its own in time, too: scans of one stage would hold all automata at once.
            state = stored(state, f"scanned_{number}")
    return state


def _scanner(spark: SparkSession, rows: list[tuple[str, str]], window: int, last: bool):
    shared, key = spark.sparkContext.broadcast(rows), uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _built:
            _built.clear()
            _built[key] = Machine(shared.value, window)
        for batch in batches:
            n_words, all_hits, all_items = [], [], []
            for text, hits, items in zip(
                batch["doc_text"], batch["hits"].to_pylist(), batch["items"].to_pylist(), strict=True
            ):
                n, runs, found = _built[key].find(text.as_py())
                n_words.append(n)
                runs = merged(runs + [(h["first"], h["last"]) for h in hits]) if runs else None
                all_hits.append([{"first": a, "last": b} for a, b in runs] if runs else hits)
                all_items.append(sorted(found.union(items)) if found else items)
            scanned = pa.RecordBatch.from_arrays(
                [
                    batch["row"],
                    batch["doc_text"],
                    pa.array(n_words, pa.int64()),
                    pa.array(all_hits, batch.schema.field("hits").type),
                    pa.array(all_items, batch.schema.field("items").type),
                ],
                names=batch.schema.names,
            )
            yield _closed(scanned) if last else scanned

    return run


def _closed(batch: pa.RecordBatch) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    n_hit, spans = [], []
    for i, hits in enumerate(batch["hits"].to_pylist()):
        runs = [(h["first"], h["last"]) for h in hits]
        n_hit.append(sum(b - a + 1 for a, b in runs))
        places = original_spans(batch["doc_text"][i].as_py(), runs) if runs else []
        spans.append([{"start": a, "end": b} for a, b in places])
    return pa.RecordBatch.from_arrays(
        [
            batch["row"],
            batch["n_words"],
            pa.array(n_hit, pa.int64()),
            batch["items"],
            pa.array(spans, span),
        ],
        names=["row", "n_words", "n_hit", "item_ids", "spans"],
    )
