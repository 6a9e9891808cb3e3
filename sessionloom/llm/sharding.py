"""Sharding by a keyed permutation of global row numbers, in SQL expressions only.

Rows are numbered 0..N-1 in an order that depends on their content alone. The number is
permuted by an alternating Feistel network over a grid of a * b >= N cells, walking the cycle
until the value is below N, and the value p gives ``shard = p mod shards`` and
``slot = p div shards``. Shards therefore differ by one row at most, slots have no gaps, and
both can be computed from a row number without the table, or turned back into it.

Defined results: rows equal in id, size and checksum are interchangeable; a null id sorts
first; a null text has size 1; an empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.common import stored, text_of

ROUNDS = 6
SEED = 20_240_601


def grid(n: int) -> tuple[int, int]:
    """Sides (a, b) with n <= a * b < n + a, about equal."""
    a = math.isqrt(max(n - 1, 0)) + 1
    return a, max(1, -(-n // a))


def _walk_steps(n: int) -> int:
    """Fewer than a cells lie outside [0, n), so a walk has fewer than a steps. Beyond 64 the
    chance of 64 steps outside is below 64 ** -64; the walk raises an error then."""
    return min(grid(n)[0], 64)


def _rounds(x: str, n: int, seed: int, inverse: bool) -> str:
    """One pass of the network over the cell ``x = r * a + l``: even rounds shift l by a hash
    of r, odd rounds r by a hash of l."""
    a, b = grid(n)
    sign = "-" if inverse else "+"
    state = f"named_struct('l', pmod({x}, {a}L), 'r', ({x}) div {a}L)"
    turns = range(ROUNDS)
    shift_l = f"named_struct('l', pmod(s.l {sign} pmod(xxhash64({seed}L, t, s.r), {a}L), {a}L), 'r', s.r)"
    shift_r = f"named_struct('l', s.l, 'r', pmod(s.r {sign} pmod(xxhash64({seed}L, t, s.l), {b}L), {b}L))"
    body = f"if(t % 2 = 0, {shift_l}, {shift_r})"
    order = ", ".join(str(t) for t in (reversed(turns) if inverse else turns))
    return f"aggregate(array({order}), {state}, (s, t) -> {body}, s -> s.r * {a}L + s.l)"


def _walk(x: str, n: int, seed: int, inverse: bool) -> Column:
    again = _rounds("p", n, seed, inverse)
    walked = (
        f"aggregate(sequence(1, {_walk_steps(n)}), {_rounds(x, n, seed, inverse)}, "
        f"(p, i) -> if(p < {n}L, p, {again}), "
        f"p -> if(p < {n}L, p, raise_error('cycle walk too long')))"
    )
    return F.expr(walked)


def permuted(number: str, n: int, seed: int = SEED) -> Column:
    """Place in [0, n) of row ``number`` (a long column in [0, n))."""
    return _walk(number, n, seed, inverse=False)


def unpermuted(place: str, n: int, seed: int = SEED) -> Column:
    """Row number at ``place = slot * shards + shard``."""
    return _walk(place, n, seed, inverse=True)


def numbered(rows: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """``rows`` with ``number``: 0..N-1 by ``keys``, without gaps, without one task seeing all.

    Sorted by range into partitions, each numbers its own rows, and the rows before a
    partition are added, of which there is one sum per partition. The sorted rows are stored
    in between, as a range sort may cut elsewhere when it runs again. Rows equal in all keys
    still spread, by a number of their own.
    """
    tie = rows.withColumn("tie", F.monotonically_increasing_id())
    ranged = (
        tie.repartitionByRange(*([partitions] if partitions else []), *keys, "tie")
        .sortWithinPartitions(*keys, "tie")
        .withColumn("place", F.monotonically_increasing_id())
        .drop("tie")
    )
    ranged = stored(ranged, "numbered").withColumn("part", F.expr("shiftright(place, 33)"))
    counts = ranged.groupBy("part").agg(F.count("*").alias("in_part"))
    before = counts.select(
        "part",
        F.expr("sum(in_part) over (order by part) - in_part").alias("before"),
    )
    return (
        # One row per partition of the sort.
        ranged.join(F.broadcast(before), "part")
        .withColumn("number", F.col("before") + F.expr("place - shiftleft(part, 33)"))
        .drop("part", "before", "place")
    )


def sharded(
    docs: DataFrame,
    shards: int,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, size, text_crc32, number, shard, slot) of every row.

    Only id, size and checksum are sorted, never the texts.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(text_of(text)) + 1).cast("long").alias("size"),
        F.crc32(text_of(text).cast("binary")).alias("text_crc32"),
    )
    numbers = numbered(rows, ["doc_id", "size", "text_crc32"])
    n = numbers.count()
    placed = numbers.withColumn("p", permuted("number", max(n, 1), seed))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        "number",
        F.expr(f"cast(p % {shards} as int)").alias("shard"),
        F.expr(f"p div {shards}").alias("slot"),
    )
