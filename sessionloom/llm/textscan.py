"""Vectorised scans over UTF-8 bytes: words, hashes of ranges, comparisons of ranges."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

# Bytes scanned at once; one longer text is scanned alone.
AT_ONCE = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True

_random = np.random.Generator(np.random.PCG64(20_240_601))
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# An odd multiplier has an inverse modulo 2**64; 3 modulo 8 keeps powers apart longest.
_BASE = 0x9E3779B97F4A7C13
_INVERSE = pow(_BASE, -1, 1 << 64)
# Powers are made of two tables of this size: base ** (i mod LOW) and base ** (LOW * (i div LOW)).
LOW_BITS = 21
LOW = 1 << LOW_BITS
_tables: dict[tuple[int, int], np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), kept for later calls; n is a multiple of 1024."""
    have = _tables.get((base, 0))
    if have is None or len(have) < n:
        have = np.ones(n, np.uint64)
        have[1:] = np.uint64(base)
        _tables[base, 0] = have = np.multiply.accumulate(have)
    return have[:n]


def _power_at(base: int, places: np.ndarray) -> np.ndarray:
    """base ** place for each place."""
    low = _powers(base, LOW)
    if not len(places) or int(places.max()) < LOW:
        return low[places]
    high = _powers(pow(base, LOW, 1 << 64), ((int(places.max()) // LOW) | 1023) + 1)
    return low[places & (LOW - 1)] * high[places >> LOW_BITS]


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers, so that low bits and order are random."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with H[i] = sum of code(byte j) * base ** j over j < i, modulo 2**64."""
    sums = np.zeros(len(data) + 1, np.uint64)
    low = _powers(_BASE, LOW)
    for a in range(0, len(data), LOW):
        some = _BYTE[data[a : a + LOW]]
        some *= low[: len(some)]
        np.cumsum(some, out=some)
        some *= np.uint64(pow(_BASE, a, 1 << 64))
        np.add(some, sums[a], out=sums[a + 1 : a + 1 + len(some)])
    return sums


def range_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes in [start, end), the same wherever they stand."""
    return mixed((sums[ends] - sums[starts]) * _power_at(_INVERSE, starts))


def gathered(texts: Iterable[bytes], limit: int = AT_ONCE) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first, texts) in runs of about ``limit`` bytes."""
    run: list[bytes] = []
    size = first = 0
    for number, text in enumerate(texts):
        if run and size + len(text) > limit:
            yield first, run
            run, size, first = [], 0, number
        run.append(text)
        size += len(text)
    if run:
        yield first, run


def is_space(data: np.ndarray) -> np.ndarray:
    """Which bytes are white space."""
    return _SPACE[data]


class Words:
    """Words of several texts, joined by one space each.

    ``data``: the bytes of all words, one space after each; ``starts``, ``ends``: places of
    the words in it; ``doc``: the text each word is from.
    """

    def __init__(self, texts: list[bytes]) -> None:
        raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        gap = _SPACE[raw]
        keep = ~gap
        # The first white space behind each word stays and becomes the space.
        keep[1:] |= ~gap[:-1]
        self.data = np.where(gap, np.uint8(32), raw)[keep]
        self.ends = np.flatnonzero(self.data == 32)
        self.starts = np.concatenate(([0], self.ends[:-1] + 1)) if len(self.ends) else self.ends
        at = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
        self.doc = np.searchsorted(np.cumsum(sizes), at, side="right")
        self.n_docs = len(texts)

    def per_doc(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs)


def equal_ranges(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether data[a : a + length] equals data[b : b + length], for each pair, byte by byte."""
    equal = np.ones(len(a), bool)
    padded = np.concatenate((data, np.zeros(16, np.uint8)))
    # Eight bytes from every place, as one little-endian number.
    eight = np.ndarray(len(data) + 9, "<u8", padded, strides=(1,))
    left, done = np.flatnonzero(length > 0), 0
    while len(left):
        rest = length[left] - done
        differ = eight[a[left] + done] ^ eight[b[left] + done]
        # Bytes behind the end do not count: they are the high ones.
        differ <<= np.uint64(8) * np.maximum(8 - rest, 0).astype(np.uint64)
        same = differ == 0
        equal[left[~same]] = False
        done += 8
        left = left[same & (rest > 8)]
    return equal


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n places lie in [start, start + size) of any start."""
    upto = np.bincount(starts, minlength=n)[:n]
    np.cumsum(upto, out=upto)
    out = upto > 0
    out[size:] = upto[size:] > upto[: max(n - size, 0)]
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    have, out = 1, values
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:]) if len(out) > have else out[:0]
        have *= 2
    more = width - have
    if more:
        out = np.minimum(out[:-more], out[more:]) if len(out) > more else out[:0]
    return out
