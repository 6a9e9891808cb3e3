"""Corpus order by prefix-free parsing.

A rolling hash over ``TRIGGER`` bytes marks places that depend on those bytes alone. They cut
texts into phrases that overlap by one trigger, none a proper prefix of another. Suffixes of
the distinct phrases (the dictionary) and suffixes of the sequence of phrases (the parse) are
each sorted by doubling, and together they give the order of all suffixes of the text:
first by what is left of the phrase a suffix begins in, then by the parse behind it.
"""

from __future__ import annotations

import numpy as np

from sessionloom.llm.textscan import equal_ranges, prefix_hash, range_hash

TRIGGER = 12
# One place in so many is a trigger.
SPACING = 24


def triggers(sums: np.ndarray) -> np.ndarray:
    """Whether a trigger starts at each place, from the prefix hash of the bytes."""
    n = len(sums) - TRIGGER
    at = np.arange(max(n, 0))
    return range_hash(sums, at, at + TRIGGER) % np.uint64(SPACING) == 0


def refined(ranks: np.ndarray, ends: np.ndarray, depth: int, enough: int) -> np.ndarray:
    """Ranks of suffixes by doubling.

    ``ranks[i]`` orders suffixes by their first ``depth`` symbols, as the number of smaller
    suffixes; ``ends[i]`` is where the string of place i ends. Doubles until no two suffixes
    are tied that could still differ, or ``enough`` symbols are compared.
    """
    place = np.arange(len(ranks))
    while depth < enough:
        size = np.bincount(ranks, minlength=len(ranks))
        longer = ends - place > depth
        open_ranks = np.zeros(len(ranks), bool)
        open_ranks[ranks[longer & (size[ranks] > 1)]] = True
        todo = np.flatnonzero(open_ranks[ranks])
        if not len(todo):
            break
        more = longer[todo]
        behind = np.zeros(len(todo), np.int64)
        behind[more] = ranks[todo[more] + depth] + 1
        order = np.lexsort((behind, ranks[todo]))
        todo, behind, before = todo[order], behind[order], ranks[todo[order]]
        first = np.concatenate(([True], before[1:] != before[:-1]))
        new = first | np.concatenate(([True], behind[1:] != behind[:-1]))
        at = np.arange(len(todo))
        group = np.maximum.accumulate(np.where(first, at, 0))
        start = np.maximum.accumulate(np.where(new, at, 0))
        ranks = ranks.copy()
        ranks[todo] = before + start - group
        depth *= 2
    return ranks


def dense(keys: np.ndarray) -> np.ndarray:
    """For each key the number of smaller ones."""
    order = np.argsort(keys, kind="stable")
    at = np.arange(len(keys))
    new = np.concatenate(([True], keys[order][1:] != keys[order][:-1])) if len(keys) else at
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = np.maximum.accumulate(np.where(new, at, 0)) if len(keys) else at
    return ranks


def _dictionary_ranks(text: np.ndarray, ends: np.ndarray, enough: int) -> np.ndarray:
    """Rank of every suffix of every phrase; ``ends[i]``: end of the phrase of place i."""
    n = len(text)
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    key = np.zeros(n, np.uint64)
    left = ends - np.arange(n)
    for k in range(8):
        # No byte of UTF-8 is 255, so 0 is free for the end of the phrase.
        value = np.where(left > k, padded[k : k + n] + np.uint8(1), np.uint8(0))
        key = (key << np.uint64(8)) | value
    return refined(dense(key), ends, 8, enough)


def repeated(strings: list[bytes], span: int) -> np.ndarray:
    """For every place of every string with ``span`` bytes from it on, in order, whether these
    bytes also start at another such place."""
    text = np.frombuffer(b"".join(strings), np.uint8)
    sizes = np.fromiter((len(s) for s in strings), np.int64, len(strings))
    stops = np.cumsum(sizes)
    begins = stops - sizes
    # Phrases: from the start of a string or a trigger to the end of the next trigger.
    mark = np.zeros(len(text), bool)
    found = triggers(prefix_hash(text))
    mark[: len(found)] = found
    starts = np.flatnonzero(mark)
    owner = np.searchsorted(stops, starts, side="right")
    starts = starts[starts + TRIGGER <= stops[owner]]
    starts = np.union1d(starts, begins)
    owner = np.searchsorted(stops, starts, side="right")
    last = np.concatenate((owner[1:] != owner[:-1], [True]))
    ends = np.where(last, stops[owner], np.append(starts[1:], 0) + TRIGGER)
    body = text.tobytes()
    phrases = [body[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    dictionary = sorted(set(phrases))
    number = {phrase: i for i, phrase in enumerate(dictionary)}
    parse = np.fromiter(map(number.__getitem__, phrases), np.int64, len(phrases))
    # Dictionary: all its phrases in order, one after the other.
    words = np.frombuffer(b"".join(dictionary), np.uint8)
    word_sizes = np.fromiter((len(p) for p in dictionary), np.int64, len(dictionary))
    word_ends = np.cumsum(word_sizes)
    alpha = _dictionary_ranks(words, np.repeat(word_ends, word_sizes), span)
    # Parse: a suffix ends with its string. A phrase adds a byte at least.
    string_end = np.flatnonzero(last) + 1
    behind = refined(dense(parse), string_end[owner], 1, span)
    # Corpus order of the places that count.
    counts = np.maximum(sizes - span + 1, 0)
    step = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    place = np.repeat(begins, counts) + step
    phrase = np.searchsorted(starts, place, side="right") - 1
    rest = alpha[(word_ends - word_sizes)[parse[phrase]] + place - starts[phrase]]
    follow = np.where(last[phrase], 0, np.append(behind, 0)[phrase + 1] + 1)
    order = np.argsort(rest * (len(parse) + 1) + follow, kind="stable")
    x, y = order[:-1], order[1:]
    equal = equal_ranges(text, place[x], place[y], np.full(len(x), span))
    out = np.zeros(len(place), bool)
    out[x[equal]] = True
    out[y[equal]] = True
    return out
