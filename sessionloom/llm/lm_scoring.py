"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax.

P(token | history) = P(class of token | history) * P(token | class, history). The most frequent
words and the end of a text are classes of their own, all other words fall into hashed classes.
Both factors are log-linear.

The class factor has hashed features of the history (previous word, the word before, both, and
a skip pair) on top of the class prior. In each round every task runs gradient steps over its
part of the training texts from the weights of the round before, and rows of weights are averaged
by how often each task met them. A round takes its own share of the documents, so that all rounds
together read every training text once. This table has a fixed size, set by parameters.

The word factor has a feature per pair of previous word (hashed to rows four times as many as the
vocabulary has words) and word of a training text, on top of the word's share of its class:

  P(w | c, v) = P(w | c) exp(u[v, w]) / Z(v, c),  Z(v, c) = 1 + sum of P(w | c) (exp(u[v, w]) - 1)

where the sum runs over the words of the class seen behind v alone, so it is sparse and exact.
These weights grow with the corpus. They are dealt over buckets by v: a block of documents sends
each bucket its distinct pairs with their counts in training texts, the bucket fits the weights of
its rows by gradient ascent on the likelihood with a Gaussian prior, and answers u - ln Z for each
pair asked for. All texts, training or held out, are scored by the one model so made.

Counts of all training words are summed exactly in buckets of words. A word that no training text
has, shares one word's room in its class with all others of the kind.

A null text is empty and is scored as its end alone; a null id counts as the text ''; repeated
rows count each; without training texts every token is unseen; an empty table gives an empty
table. Words are told apart by 64 bits of their hash, and behind one row of v by 16 bits and their
count.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.automata import from_planes, planes
from sessionloom.llm.blocks import (
    BLOCK_BYTES,
    BLOCKS,
    NO_ID,
    OWN,
    TOTAL,
    answered,
    finished,
    sent,
    sent_on,
    shuffled,
    tallied,
)
from sessionloom.llm.common import checkpointed, packed, releasing, stored, text_bytes, unpacked
from sessionloom.llm.textscan import AT_ONCE, Words, mixed, prefix_hash, range_hash

HEADS = 15
HASHED = 16
# Rows of the weight table; features are hashed into it.
ROWS = 1 << 14
ROUNDS = 2
STEP = 0.3
BATCH = 4096
SMOOTH = 0.5
# Precision of the Gaussian prior of pair weights (the best of a grid on held-out texts of sf0.01 and
# sf0.1), and gradient steps to fit them.
PRIOR = 0.1
FIT_STEPS = 10
WORD_BUCKET_BYTES = 8 << 20
# Text whose pairs make up a bucket.
PAIR_BUCKET_BYTES = 16 << 20
CLASSES = 1 + HEADS + HASHED
# Times a row of weights is met in most batches at most.
FEW = 6
# Scores that differ by less have odds within the normal 32-bit floats.
NEAR = 80.0
_ONES = np.ones(CLASSES, np.float32)
# Parts in which weights are summed, and tasks summed together first.
SLICES = 16
TASKS_AT_ONCE = 256

END = np.uint64(0x0E0D)
_BEGIN = np.uint64(0xB0B0)
_PAIRS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]

RESULT = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)


def remainders(columns: tuple) -> np.ndarray:
    """crc32 of the id as text, for each document of a block."""
    names = (b"" if null else str(doc).encode() for doc, null in zip(*columns[:2], strict=True))
    return np.fromiter(map(zlib.crc32, names), np.int64, len(columns[0]))


def coded_blocks(docs: DataFrame, doc_id: str, text: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, payload): documents of a few MB of text as columns (ids, which are null, [words,
    places], tokens per document). ``places`` are the numbers of the words of all documents, the
    most frequent first, 0 for the end of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        number = 0
        coded = _Coded()
        for batch in batches:
            for row in range(batch.num_rows):
                coded.add(batch["doc_id"][row].as_py(), batch["text"][row].as_py())
                if coded.size >= block_bytes:
                    yield coded.block(first + number)
                    coded, number = _Coded(), number + 1
        if coded.ids:
            yield coded.block(first + number)

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    return rows.mapInArrow(releasing(run), BLOCKS)


class _Coded:
    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.tokens: list[int] = []
        self.places: list[np.ndarray] = []
        # Number 0 is the end of a text.
        self.numbers: dict[bytes, int] = defaultdict(count(1).__next__)
        self.size = 0

    def add(self, doc_id: int | None, text: bytes) -> None:
        n = 1
        for part in _parts(text.lower()):
            words = part.split()
            self.places.append(np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words)))
            n += len(words)
        self.places.append(np.zeros(1, np.int64))
        self.ids.append(doc_id)
        self.tokens.append(n)
        self.size += len(text) + 16

    def block(self, number: int) -> pa.RecordBatch:
        at = np.concatenate(self.places)
        order = np.argsort(-np.bincount(at, minlength=len(self.numbers) + 1)[1:], kind="stable")
        rank = np.zeros(len(order) + 1, np.int64)
        rank[order + 1] = np.arange(1, len(order) + 1)
        words = list(self.numbers)
        width, body = planes(rank[at])
        columns = (
            [NO_ID if doc is None else doc for doc in self.ids],
            [doc is None for doc in self.ids],
            [b" ".join([words[i] for i in order.tolist()]), body],
            (width, self.tokens),
        )
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([packed(columns)], pa.binary())],
            ["block", "payload"],
        )


def _parts(text: bytes) -> Iterator[bytes]:
    """A long text in parts of about AT_ONCE bytes that end at a space."""
    at = 0
    while len(text) - at > 2 * AT_ONCE:
        end = text.find(b" ", at + AT_ONCE)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:] if at else text


class Tokens:
    """Tokens of a block. ``at``: number of each token's word, 0 for an end; ``doc``: its document;
    ``words``, ``hashes``: words and hashes by number, that of the end first and that of what stands
    before a text last."""

    def __init__(self, columns: tuple) -> None:
        body, places = columns[2]
        width, sizes = columns[3]
        self.words = body.split(b" ") if body else []
        self.hashes = np.concatenate(([END], word_hashes(self.words), [_BEGIN]))
        self.at = from_planes((width, places))
        self.sizes = np.array(sizes, np.int64)
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def back(self, steps: int) -> np.ndarray:
        """Numbers of the words some steps before each token."""
        begin = len(self.hashes) - 1
        out = np.full(len(self.at), begin)
        out[steps:] = self.at[: max(len(self.at) - steps, 0)]
        for step in range(steps):
            early = self.starts[self.sizes > step] + step
            out[early] = begin
        return out

    def features(self, some: np.ndarray | slice = slice(None)) -> list[np.ndarray]:
        """Rows of the class factor's weights for each of some tokens."""
        rows = np.uint64(ROWS)
        one, two, three = (self.back(steps)[some] for steps in (1, 2, 3))
        first = (mixed(self.hashes) % rows).astype(np.uint16)
        second = (mixed(self.hashes ^ _PAIRS[0]) % rows).astype(np.uint16)
        pair, skip = self.hashes * _PAIRS[1], self.hashes * _PAIRS[2]
        # 16 bits sort fastest.
        return [
            first[one],
            second[two],
            (mixed(pair[one] + self.hashes[two]) % rows).astype(np.uint16),
            (mixed(skip[one] + self.hashes[three]) % rows).astype(np.uint16),
        ]

    def routes(self, buckets: int) -> list[tuple[int, np.ndarray]]:
        """(bucket, numbers of its words less one)."""
        bucket = (mixed(self.hashes[1:-1]) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        return [(int(bucket[part[0]]), part) for part in np.split(order, cuts) if len(part)]


def classes_of(hashes: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """0: end; 1..HEADS: the frequent words, by sorted hash; above: hashed classes."""
    out = (mixed(hashes) % np.uint64(HASHED)).astype(np.int64) + 1 + HEADS
    if len(heads):
        at = np.minimum(np.searchsorted(heads, hashes), len(heads) - 1)
        out = np.where(heads[at] == hashes, at + 1, out)
    return np.where(hashes == END, 0, out)


def _logits(prior: np.ndarray, weights: np.ndarray, features: list[np.ndarray]) -> np.ndarray:
    """Scores of all classes for each history, shifted so that none is above 0 and their odds are
    numbers."""
    logits = weights.take(features[0], axis=0)
    for rows in features[1:]:
        logits += weights.take(rows, axis=0)
    logits += prior
    if not len(logits):
        return logits
    top = logits.max()
    if top - logits.min() < NEAR:
        logits -= top
        return logits
    # Far apart: shifted so that the largest of each history is 0.
    largest = logits
    while largest.shape[1] > 1:
        # Halves against each other: far faster than a maximum along short rows.
        half = (largest.shape[1] + 1) // 2
        largest = np.maximum(largest[:, :half], largest[:, -half:])
    logits -= largest
    return logits


def class_probabilities(
    prior: np.ndarray, weights: np.ndarray, features: list[np.ndarray]
) -> np.ndarray:
    odds = _logits(prior, weights, features)
    np.exp(odds, out=odds)
    odds /= (odds @ _ONES)[:, None]
    return odds


def class_logs(
    prior: np.ndarray, weights: np.ndarray, features: list[np.ndarray], kind: np.ndarray
) -> np.ndarray:
    """Log probability of one class for each history."""
    logits = _logits(prior, weights, features)
    wanted = logits[np.arange(len(kind)), kind]
    return wanted - np.log(np.exp(logits, out=logits) @ _ONES)


def _word_counts(buckets: int):
    """Distinct words of a block with their counts in its training texts."""

    def send(columns: tuple) -> list[tuple[int, object]]:
        tokens = Tokens(columns)
        train = (remainders(columns) % 5 != 1)[tokens.doc]
        counts = np.bincount(tokens.at[train], minlength=len(tokens.hashes) - 1)[1:]
        return [
            (bucket, (b" ".join([tokens.words[i] for i in mine.tolist()]), planes(counts[mine])))
            for bucket, mine in tokens.routes(buckets)
        ]

    return send


def _totals(messages: list) -> dict[bytes, int]:
    totals: dict[bytes, int] = {}
    for text, counts in messages:
        pairs = zip(text.split(b" "), from_planes(counts).tolist(), strict=True)
        for word, count in pairs:
            totals[word] = totals.get(word, 0) + count
    return totals


def _tally_words(_: int, messages: list) -> tuple[list, object]:
    """Counts in all training texts, to every block for its words. Of its own the bucket keeps
    tokens and words by hashed class, and its most frequent words."""
    totals = _totals(messages)
    told = [planes(np.array([totals[w] for w in t.split(b" ")], np.int64)) for t, _ in messages]
    counted = sorted(((c, w) for w, c in totals.items() if c), key=lambda x: (-x[0], x[1]))
    counts = np.array([c for c, _ in counted], np.int64)
    kind = classes_of(word_hashes([w for _, w in counted]), np.zeros(0, np.uint64))
    tokens = np.bincount(kind, counts, CLASSES).astype(np.int64)
    words = np.bincount(kind, minlength=CLASSES)
    return told, (tokens.tolist(), words.tolist(), counted[:HEADS])


def _bucket_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for payload in batch["payload"]:
            tokens, words, top = unpacked(payload.as_py())
            classes = [{"tokens": t, "words": w} for t, w in zip(tokens, words, strict=True)]
            row = {"classes": classes, "top": [{"count": c, "word": w} for c, w in top]}
            yield pa.RecordBatch.from_pylist([row], _TOTALS)


_TOTALS = pa.schema(
    [
        ("classes", pa.list_(pa.struct([("tokens", pa.int64()), ("words", pa.int64())]))),
        ("top", pa.list_(pa.struct([("count", pa.int64()), ("word", pa.binary())]))),
    ]
)


def word_hashes(words: list[bytes]) -> np.ndarray:
    found = Words(words)
    return range_hash(prefix_hash(found.data), found.starts, found.ends)


class Statistics:
    """Counts of the training texts by class: fixed in size, whatever the corpus."""

    def __init__(self, counted: DataFrame, documents: int) -> None:
        """``counted``: answers and own rows of the buckets of words."""
        totals = counted.where(f"block <= {TOTAL}").mapInArrow(
            _bucket_totals,
            "classes array<struct<tokens:bigint,words:bigint>>, "
            "top array<struct<count:bigint,word:binary>>",
        )
        totals = stored(totals, "word_totals")
        top = (
            totals.select(F.explode("top").alias("top"))
            .orderBy(F.desc("top.count"), "top.word")
            .limit(HEADS)
            .collect()
        )
        head_hashes = word_hashes([bytes(r["top"]["word"]) for r in top])
        order = np.argsort(head_hashes)
        self.heads = head_hashes[order]
        head_counts = np.array([r["top"]["count"] for r in top], np.int64)[order]
        tokens, words = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        sums = totals.select(F.posexplode("classes").alias("kind", "n")).groupBy("kind")
        for row in sums.agg(F.sum("n.tokens").alias("t"), F.sum("n.words").alias("w")).collect():
            tokens[row["kind"]], words[row["kind"]] = row["t"], row["w"]
        self.documents = documents
        self.tokens = int(tokens.sum()) + documents
        self.distinct = int(words.sum()) + (documents > 0)
        # Rows of the word factor, for previous words.
        self.rows = 1 << min(27, max(10, 2 + int(self.distinct).bit_length()))
        # The frequent words leave their hashed classes.
        hashed = classes_of(self.heads, np.zeros(0, np.uint64))
        np.subtract.at(tokens, hashed, head_counts)
        np.subtract.at(words, hashed, 1)
        self.word_total = tokens + SMOOTH * (words + 1)
        counts = tokens.astype(float)
        counts[0] = documents
        counts[1 : 1 + len(head_counts)] = head_counts
        self.prior = np.log((counts + SMOOTH) / (counts + SMOOTH).sum()).astype(np.float32)


def _train(weights: np.ndarray, statistics: Statistics, turn: int):
    """Gradient steps of one task over the training texts of a round; its change of each row,
    times how often it met the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = weights.copy()
        met = np.zeros(ROWS, np.float32)
        for batch in batches:
            for payload in batch["payload"]:
                columns = unpacked(payload.as_py())
                left = remainders(columns)
                taken = (left % 5 != 1) & (left // 5 % ROUNDS == turn)
                tokens = Tokens(columns)
                some = np.flatnonzero(taken[tokens.doc])
                kind = classes_of(tokens.hashes, statistics.heads)[tokens.at[some]]
                _steps(mine, met, statistics, kind, tokens.features(some))
        change = (mine - weights) * met[:, None]
        group = TaskContext.get().partitionId() // TASKS_AT_ONCE
        for number, part in enumerate(zip(np.split(change, SLICES), np.split(met, SLICES), strict=True)):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([group], pa.int64()),
                    pa.array([packed(part)], pa.binary()),
                ],
                ["slice", "tasks", "payload"],
            )

    return run


def _steps(
    weights: np.ndarray,
    met: np.ndarray,
    statistics: Statistics,
    kind: np.ndarray,
    features: list[np.ndarray],
) -> None:
    for a in range(0, len(kind), BATCH):
        some = [f[a : a + BATCH] for f in features]
        gradient = class_probabilities(statistics.prior, weights, some)
        gradient[np.arange(len(gradient)), kind[a : a + BATCH]] -= 1
        for rows in some:
            order = np.argsort(rows, kind="stable")
            ordered = rows[order]
            first = np.flatnonzero(np.diff(ordered.astype(np.int64), prepend=-1))
            times = np.diff(np.append(first, len(rows)))
            # Rows met most often first: those met more than k times come before all others.
            often = np.argsort(-times.astype(np.int16), kind="stable")
            first, times = first[often], times[often]
            touched = ordered[first].astype(np.intp)
            met[touched] += times
            total = gradient.take(order[first], axis=0)
            for k in range(1, FEW):
                more = int(np.searchsorted(-times, -k))
                total[:more] += gradient.take(order[first[:more] + k], axis=0)
            # Most rows are met a few times in a batch; only the others need sums.
            several = int(np.searchsorted(-times, -FEW))
            if several:
                size = times[:several] - FEW
                begin = np.cumsum(size) - size
                inside = np.repeat(first[:several] + FEW - begin, size) + np.arange(int(size.sum()))
                total[:several] += np.add.reduceat(gradient.take(order[inside], axis=0), begin, axis=0)
            total *= (STEP / np.sqrt(1 + met[touched]))[:, None]
            # Rows are put back as one item each.
            row = f"V{weights.strides[0]}"
            weights.view(row)[touched, 0] = (weights.take(touched, axis=0) - total).view(row)[:, 0]


def _summed(rows: pa.Table) -> pa.Table:
    change, met = unpacked(rows["payload"][0].as_py())
    for payload in rows["payload"][1:]:
        more, times = unpacked(payload.as_py())
        change, met = change + more, met + times
    return pa.table(
        {
            "slice": rows["slice"][:1],
            "tasks": rows["tasks"][:1],
            "payload": pa.array([packed((change, met))], pa.binary()),
        }
    )


def trained(blocks: DataFrame, statistics: Statistics) -> np.ndarray:
    """Weights of the class factor (ROWS x CLASSES) from the training texts of all blocks."""
    schema = "slice bigint, tasks bigint, payload binary"
    weights = np.zeros((ROWS, CLASSES), np.float32)
    for turn in range(ROUNDS):
        parts = blocks.mapInArrow(releasing(_train(weights, statistics, turn)), schema)
        parts = parts.groupBy("slice", "tasks").applyInArrow(_summed, schema)
        parts = parts.groupBy("slice").applyInArrow(_summed, schema)
        size = ROWS // SLICES
        for row in parts.collect():
            change, met = unpacked(bytes(row["payload"]))
            place = slice(row["slice"] * size, (row["slice"] + 1) * size)
            weights[place] += change / np.maximum(met, 1)[:, None]
    return weights


# -- word factor ---------------------------------------------------------------------------------


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values (not below 0) in order, and the place there of each: as ``np.unique`` says,
    by 16 bits at a time, which sort fastest."""
    order = np.argsort(values.astype(np.uint16), kind="stable")
    top = int(values.max(initial=0))
    for shift in range(16, top.bit_length(), 16):
        part = (values[order] >> shift).astype(np.uint16)
        order = order[np.argsort(part, kind="stable")]
    ordered = values[order]
    new = np.append(True, ordered[1:] != ordered[:-1])[: len(values)]
    at = np.empty(len(values), np.int64)
    at[order] = np.cumsum(new) - 1
    return ordered[new], at


class Pairs:
    """Distinct pairs of previous and present word in a block, for words in classes of several.
    ``key``: row of the previous word, class, 16 bits of the word; in its order ``count``,
    the word's count in all training texts, and ``seen``, the pair's in those of the block.
    ``number``: the pair of each token, or -1."""

    def __init__(self, tokens: Tokens, kind: np.ndarray, counts: np.ndarray, train: np.ndarray, rows: int) -> None:
        begin = len(tokens.hashes)
        several = kind[tokens.at] > HEADS
        before = tokens.back(1)[several]
        pair = before * begin + tokens.at[several]
        pairs, at = distinct(pair)
        previous, word = pairs // begin, pairs % begin
        code = mixed(tokens.hashes ^ _PAIRS[2])
        row = (code % np.uint64(rows))[previous]
        short = code >> np.uint64(48)
        key = (row * np.uint64(CLASSES) + kind[word].astype(np.uint64)) << np.uint64(16) | short[word]
        order = np.argsort(key, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.key, self.count = key[order].astype(np.int64), counts[word][order]
        times = np.bincount(at[train[several]], minlength=len(pairs))
        self.seen = times[order]
        self.number = np.full(len(tokens.at), -1)
        self.number[several] = place[at]

    def routes(self, buckets: int, rows: int) -> list[tuple[int, slice]]:
        """(bucket, its pairs): a bucket holds a range of rows."""
        edges = [-(-b * rows // buckets) * CLASSES << 16 for b in range(buckets)]
        cuts = [*np.searchsorted(self.key, edges).tolist(), len(self.key)]
        return [(b, slice(cuts[b], cuts[b + 1])) for b in range(buckets) if cuts[b] < cuts[b + 1]]


def _block_pairs(columns: tuple, tokens: Tokens, statistics: Statistics, counts: np.ndarray) -> tuple[np.ndarray, Pairs]:
    kind = classes_of(tokens.hashes, statistics.heads)
    train = (remainders(columns) % 5 != 1)[tokens.doc]
    return kind, Pairs(tokens, kind, counts, train, statistics.rows)


def _send_pairs(statistics: Statistics, buckets: int, pair_buckets: int):
    """Pairs of a block. It notes the counts of its words in all training texts."""

    def send(columns: tuple, answers: dict[int, object]) -> list[tuple[int, object]]:
        tokens = Tokens(columns)
        counts = np.zeros(len(tokens.hashes), np.int64)
        for bucket, mine in tokens.routes(buckets):
            counts[mine + 1] = from_planes(answers[bucket])
        _, pairs = _block_pairs(columns, tokens, statistics, counts)
        out: list[tuple[int, object]] = [(OWN, planes(counts))]
        for bucket, mine in pairs.routes(pair_buckets, statistics.rows):
            steps = np.diff(pairs.key[mine], prepend=0)
            out.append((bucket, tuple(map(planes, (steps, pairs.count[mine], pairs.seen[mine])))))
        return out

    return send


def _short(values: np.ndarray) -> bytes:
    """32-bit floats by byte planes, without their last 8 bits: 16 bits of precision stay."""
    bits = (values.astype("<f4").view(np.uint32) + np.uint32(128)) >> np.uint32(8)
    return planes(bits.astype(np.int64))


def _long(data: tuple[int, bytes]) -> np.ndarray:
    return (from_planes(data).astype(np.uint32) << np.uint32(8)).view("<f4")


def fitted(share: np.ndarray, seen: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weights, ln Z of each pair's group) of pairs in order of their groups: ``share`` is P(w | c),
    ``seen`` the pair's count. Pairs that no training text has get no weight."""
    begin = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    if not len(begin):
        return np.zeros(0), np.zeros(0)
    of = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(group))))
    total = np.add.reduceat(seen, begin)[of].astype(float)
    weight = np.zeros(len(share))
    there = (seen > 0).astype(float)
    for _ in range(FIT_STEPS):
        grown = share * np.exp(weight)
        room = 1 + np.add.reduceat(grown - share, begin)
        chance = there * grown / room[of]
        gradient = there * (seen - total * chance - PRIOR * weight)
        # Newton's step: the curvature is a diagonal less one product per group.
        scale = total * chance + PRIOR
        along = np.add.reduceat(chance * gradient / scale, begin)
        across = 1 - np.add.reduceat(total * chance**2 / scale, begin)
        step = (gradient + total * chance * (along / across)[of]) / scale
        weight += np.clip(step, -1.5, 1.5)
    room = 1 + np.add.reduceat(share * np.expm1(weight), begin)
    return weight, np.log(room)[of]


def _answer_pairs(statistics: Statistics):
    """u - ln Z of every pair of every message."""

    def answer(_: int, messages: list) -> list:
        keys = [np.cumsum(from_planes(steps)) for steps, _, _ in messages]
        key = np.concatenate(keys)
        counts = np.concatenate([from_planes(c) for _, c, _ in messages])
        seen = np.concatenate([from_planes(n) for _, _, n in messages])
        # Words of one key are told apart by their count.
        names = key.astype(np.uint64) << np.uint64(16) ^ mixed(counts.astype(np.uint64)) >> np.uint64(48)
        names, first, number = np.unique(names, return_index=True, return_inverse=True)
        group = key[first] >> 16
        order = np.argsort(group, kind="stable")
        # Names of one group are next to each other as far as 64 bits hold a row.
        kind = group[order] % CLASSES
        share = (counts[first][order] + SMOOTH) / statistics.word_total[kind]
        times = np.bincount(number, seen)[order]
        weight, room = fitted(share, times, group[order])
        told = np.empty(len(order))
        told[order] = weight - room
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        return [_short(part) for part in np.split(told[number], cuts)]

    return answer


def _score(weights: np.ndarray, statistics: Statistics, pair_buckets: int):
    def finish(columns: tuple, answers: dict[int, object]) -> pa.Table:
        counts = from_planes(answers[OWN])
        tokens = Tokens(columns)
        kinds, pairs = _block_pairs(columns, tokens, statistics, counts)
        told = np.zeros(len(pairs.key) + 1)
        for bucket, mine in pairs.routes(pair_buckets, statistics.rows):
            told[mine] = _long(answers[bucket])
        counts[0] = statistics.documents
        room = statistics.tokens + SMOOTH * (statistics.distinct + 1)
        base = np.log10((counts + SMOOTH) / room)
        own = np.where(kinds > HEADS, np.log((counts + SMOOTH) / statistics.word_total[kinds]), 0.0)
        kind = kinds[tokens.at]
        # Tokens in classes of one get the 0 behind all pairs.
        logs = own[tokens.at] + told[pairs.number]
        features = tokens.features()
        for a in range(0, len(kind), BATCH):
            some = [f[a : a + BATCH] for f in features]
            logs[a : a + BATCH] += class_logs(statistics.prior, weights, some, kind[a : a + BATCH])
        n = len(columns[0])

        def per_doc(values: np.ndarray) -> np.ndarray:
            return np.bincount(tokens.doc, values, n)

        return pa.table(
            {
                "doc_id": pa.array(columns[0], pa.int64(), mask=np.array(columns[1], bool)),
                "held_out": remainders(columns) % 5 == 1,
                "n_tokens": tokens.sizes,
                "n_known": per_doc((counts > 0)[tokens.at]).astype(np.int64),
                "train_tokens": pa.array([statistics.tokens] * n, pa.int64()),
                "base_score": per_doc(base[tokens.at]),
                "score": per_doc(logs) / np.log(10),
            }
        )

    return finish


def scored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score. Texts whose crc32(doc_id as text) leaves 1 modulo 5 are held out."""
    size = text_bytes(docs, text)
    buckets = max(1, -(-size // WORD_BUCKET_BYTES))
    pair_buckets = max(1, -(-size // PAIR_BUCKET_BYTES))
    name = F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit(""))
    documents = docs.where(F.crc32(name.cast("binary")) % 5 != 1).count()
    # Answers outlive the job that asks: the blocks must be the same ones.
    blocks = checkpointed(coded_blocks(docs, doc_id, text))
    counted = checkpointed(tallied(sent(blocks, _word_counts(buckets)), _tally_words))
    statistics = Statistics(counted, documents)
    weights = trained(blocks, statistics)
    dealt = shuffled(blocks)
    told = counted.where(f"block > {TOTAL}")
    asked = sent_on(dealt, told, _send_pairs(statistics, buckets, pair_buckets))
    answers = answered(asked, _answer_pairs(statistics))
    return finished(dealt, answers, _score(weights, statistics, pair_buckets), RESULT)
