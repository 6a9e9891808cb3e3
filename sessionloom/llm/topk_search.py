"""Exact top-k search by inner product: a ball tree per shard, branch and bound in it.

Components are floored to integers after scaling, so scores are exact integers. Rows are dealt
over shards by their place in the table, which spreads copies of one vector, and every shard is
stored with its ball tree: nodes halve the points along the axis they spread most on and keep
centre, radius and least id. No point of a node has a larger product with q than
q . centre + |q| * radius.

A search goes down the tree level by level for a whole block of queries. It first follows each
query's best child to one leaf, which gives a k-th score; then it drops every node whose bound is
below the k-th score (or equals it, with no smaller id inside), and opens the leaves left over
in the order of their bounds, the k-th score rising as it goes. Between shards the k-th score is
shared in two rounds: a query searches one shard first, and the score found there is where all
other shards start from, so most of them return few rows or none. The best rows of all shards are
ranked at the end.

Queries travel in groups of GROUP to each shard; neither a shard nor a group grows with the table.

Defined results: vectors that are null or hold null or non-finite components take no part, as
query or candidate; only vectors of one length are compared; a query meets no row of its own id,
so rows repeated under one id are no neighbours of each other, and a query that is repeated is one
query (with other components under the same id: one more); rows of a null id are no queries and
come after all others among ties. A component or a score that 64 bits cannot hold ends the job
with an error. An empty table gives an empty table. Other columns take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.llm.common import checkpointed, packed, release, stored, unpacked

K = 10
SCALE = 1024
# Every so many-th id is a query.
QUERY_EVERY = 100
# Components of a shard, 8 bytes each: at least and at most. Between the two there are as many
# shards as shuffle partitions.
LEAST, MOST = 1 << 16, 1 << 22
# Queries in a group, points in a leaf.
GROUP = 1 << 14
LEAF = 128
# Queries that go down a tree together.
AT_ONCE = 512

NO_ID = (1 << 63) - 1
NONE = -(1 << 63)
SEARCHED = "query bigint, query_id bigint, vec_id bigint, score bigint"


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two integer matrices, exact."""
    if not (a.size and b.size):
        return np.zeros((len(a), len(b)), np.int64)
    top = int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1]
    if top < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if top < 1 << 63:
        return a @ b.T
    exact = a.astype(object) @ b.T.astype(object)
    if max(abs(v) for v in exact.ravel()) >= 1 << 63:
        raise OverflowError("a score does not fit in 64 bits")
    return exact.astype(np.int64)


class BallTree:
    """Points of one length in tree order. Level d has 2**d nodes, ranges of about equal size;
    ``bounds[d]`` are their ends, ``centre``, ``radius`` and ``least_id`` go by level."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> None:
        # Equal points stay in the order of their ids, which lets a bound drop late ones.
        order = np.argsort(ids, kind="stable")
        depth = max(0, int(np.log2(max(len(ids) / leaf, 1))))
        at = [np.array([0, len(ids)])]
        values = points.astype(np.float64)
        for _ in range(depth):
            at.append(self._halved(values, order, at[-1]))
        self.points, self.ids, self.bounds = points[order], ids[order], at
        values = values[order]
        self.centre: list[np.ndarray] = []
        self.radius: list[np.ndarray] = []
        self.least_id: list[np.ndarray] = []
        for ends in at:
            start, size = ends[:-1], np.diff(ends)
            centre = np.add.reduceat(values, start) / size[:, None]
            far = ((values - np.repeat(centre, size, axis=0)) ** 2).sum(axis=1)
            self.centre.append(centre)
            self.radius.append(np.sqrt(np.maximum.reduceat(far, start)))
            self.least_id.append(np.minimum.reduceat(self.ids, start))

    @staticmethod
    def _halved(values: np.ndarray, order: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Sort each range of ``order`` along its widest axis; ends of all halves."""
        out = [0]
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            mine = order[a:b]
            some = values[mine]
            spread = some.max(axis=0) - some.min(axis=0)
            if spread.size and spread.max() > 0:
                order[a:b] = mine[np.argsort(some[:, spread.argmax()], kind="stable")]
            out += [(a + b) // 2, b]
        return np.array(out)

    def bound(self, queries: np.ndarray, sizes: np.ndarray, level: int) -> np.ndarray:
        """Upper bounds of the products with the nodes of a level."""
        centre, radius = self.centre[level], self.radius[level]
        value = queries @ centre.T + sizes[:, None] * radius
        # Room for the rounding of floating point, many times over.
        slack = sizes[:, None] * (np.sqrt((centre**2).sum(axis=1)) + radius + 1) * 1e-11 + 1e-6
        return value + slack

    def search(
        self, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of each query's k best points of other ids that reach its floor,
        ties to smaller ids."""
        found = []
        for i in range(0, len(own), AT_ONCE):
            some = slice(i, i + AT_ONCE)
            found.append(self._search(queries[some], own[some], floor[some], k))
        query = np.concatenate([q + i * AT_ONCE for i, (q, _, _) in enumerate(found)])
        return query, *(np.concatenate([f[n] for f in found]) for n in (1, 2))

    def _search(self, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int):
        n, last = len(own), len(self.bounds) - 1
        real = queries.astype(np.float64)
        sizes = np.sqrt((real**2).sum(axis=1))
        best = _Best(own, k, floor)
        # Down to each query's most promising leaf.
        node = np.zeros(n, np.int64)
        for level in range(1, last + 1):
            bound = self.bound(real, sizes, level)
            left, row = 2 * node, np.arange(n)
            node = left + (bound[row, left + 1] > bound[row, left])
        self._open(queries, best, np.arange(n), node)
        # Again from the top: pairs of query and node that the k-th score leaves.
        query, part = np.arange(n), np.zeros(n, np.int64)
        for level in range(last + 1):
            if level:
                query, part = np.repeat(query, 2), np.repeat(2 * part, 2)
                part[1::2] += 1
            bound = self.bound(real, sizes, level)[query, part]
            alive = best.may_rise(query, bound, self.least_id[level][part])
            query, part, bound = query[alive], part[alive], bound[alive]
        new = part != node[query]
        query, part, bound = query[new], part[new], bound[new]
        order = np.lexsort((-bound, query))
        query, part, bound = query[order], part[order], bound[order]
        # Of the leaves left to a query the best one, then twice as many at a time.
        many = 1
        while len(query):
            alive = best.may_rise(query, bound, self.least_id[last][part])
            query, part, bound = query[alive], part[alive], bound[alive]
            begin = np.searchsorted(query, query)
            now = np.arange(len(query)) - begin < many
            self._open(queries, best, query[now], part[now])
            query, part, bound = query[~now], part[~now], bound[~now]
            many *= 2
        return best.query, best.id, best.score

    def _open(self, queries, best: _Best, query: np.ndarray, part: np.ndarray) -> None:
        """Score the points of leaves for the queries that chose them, leaf by leaf."""
        if not len(part):
            return
        order = np.argsort(part, kind="stable")
        query, part = query[order], part[order]
        begin = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        ends = self.bounds[-1]
        for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(part)], strict=True):
            low, high = ends[part[a]], ends[part[a] + 1]
            scores = products(queries[query[a:b]], self.points[low:high])
            best.take(query[a:b], scores, self.ids[low:high])
        best.settle()


class _Best:
    """The k best (query, id, score) of each query so far, in that order; ``last`` and
    ``last_id``: the k-th score of each query and its id, NONE while there are fewer."""

    # Rows waiting to be ranked.
    WAIT = 1 << 16

    def __init__(self, own: np.ndarray, k: int, floor: np.ndarray) -> None:
        self.own, self.k, self.floor = own, k, floor
        self.query = self.id = self.score = np.zeros(0, np.int64)
        self.last = np.full(len(own), NONE, np.int64)
        self.last_id = np.full(len(own), NO_ID, np.int64)
        self._new: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._waiting = 0

    def may_rise(self, query: np.ndarray, bound: np.ndarray, least_id: np.ndarray) -> np.ndarray:
        """Whether something within a bound can still enter the k best of a query."""
        last = self.last[query]
        # Floats beyond 2**53 round: one step down keeps what is equal.
        least = np.nextafter(np.maximum(last, self.floor[query]).astype(np.float64), -np.inf)
        # What is equal must have a smaller id; below 2**52 bounds can be told apart.
        late = (least_id > self.last_id[query]) & (last != NONE) & (np.abs(last) < 1 << 52)
        return (bound >= least) & ~(late & (np.floor(bound) <= last))

    def take(self, query: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        least = np.maximum(self.last[query], self.floor[query])[:, None]
        row, place = np.nonzero((scores >= least) & (ids != self.own[query][:, None]))
        self._new.append((query[row], ids[place], scores[row, place]))
        self._waiting += len(row)
        if self._waiting > self.WAIT:
            self.settle()

    def settle(self) -> None:
        found = [(self.query, self.id, self.score), *self._new]
        query, ids, score = (np.concatenate([f[n] for f in found]) for n in range(3))
        order = np.lexsort((ids, ~score, query))
        query, ids, score = query[order], ids[order], score[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        kept = rank < self.k
        self.query, self.id, self.score = query[kept], ids[kept], score[kept]
        full = rank == self.k - 1
        self.last[query[full]], self.last_id[query[full]] = score[full], ids[full]
        self._new, self._waiting = [], 0


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64, copy=False).reshape(len(column), dim)


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy().astype(np.int64, copy=False)


def integers(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """(vec_id, v: scaled components, dim) of the vectors that take part. A component beyond 64
    bits ends the job."""
    wide = F.col(embedding).cast("array<double>")
    sound = F.col(embedding).isNotNull() & F.forall(
        wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )

    def whole(x: Column) -> Column:
        value = F.floor(F.lit(float(scale)) * x)
        far = F.abs(F.lit(float(scale)) * x) >= float(1 << 62)
        refused = F.raise_error(F.lit("a component is beyond 62 bits")).cast("long")
        return F.when(far, refused).otherwise(value)

    rows = vectors.where(sound).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.transform(wide, whole).alias("v")
    )
    return rows.withColumn("dim", F.size("v"))


def sharded(rows: DataFrame, shards: int) -> DataFrame:
    """(shard, dim, payload): a ball tree for every shard and length of vector."""

    def build(key: tuple, part: pa.Table) -> pa.Table:
        dim = key[1].as_py()
        tree = BallTree(_matrix(part["v"], dim), _ids(part["vec_id"]))
        out = pa.table(
            {
                "shard": [key[0].as_py()],
                "dim": pa.array([dim], pa.int32()),
                "payload": pa.array([packed(tree)], pa.binary()),
            }
        )
        release()
        return out

    dealt = rows.withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)))
    # Row numbers of a task are consecutive but begin at multiples of a power of two.
    dealt = dealt.withColumn("shard", F.pmod(F.col("shard") + F.spark_partition_id(), F.lit(shards)))
    schema = "shard bigint, dim int, payload binary"
    return dealt.groupBy("shard", "dim").applyInArrow(build, schema)


def _searched(trees: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Rows found by queries (shard, dim, group, query, query_id, v, floor) in their shards."""

    def search(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        none = np.zeros(0, np.int64)
        number, own, ids, scores = none, none, none, none
        if right.num_rows and left.num_rows:
            numbers, owners = _ids(right["query"]), _ids(right["query_id"])
            tree = unpacked(left["payload"][0].as_py())
            floor = right["floor"].fill_null(NONE).to_numpy().astype(np.int64)
            at, ids, scores = tree.search(_matrix(right["v"], key[1].as_py()), owners, floor, k)
            number, own = numbers[at], owners[at]
        release()
        return pa.table(
            {
                "query": number,
                "query_id": own,
                "vec_id": pa.array(ids, pa.int64(), mask=ids == NO_ID),
                "score": scores,
            }
        )

    keys = ["shard", "dim", "group"]
    return trees.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(search, SEARCHED)


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = K,
    scale: int = SCALE,
    least: int = LEAST,
    most: int = MOST,
    group: int = GROUP,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``vectors`` for each row of
    ``queries``, both with the same two columns."""
    spark = vectors.sparkSession
    rows = integers(vectors, vec_id, embedding, scale)
    components = rows.agg(F.sum("dim")).first()[0] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, min(tasks, components // least), -(-components // most))
    asking = integers(queries, vec_id, embedding, scale).where("vec_id is not null")
    asking = asking.withColumnRenamed("vec_id", "query_id").dropDuplicates(["query_id", "v"])
    # Numbers are kept in a table: both rounds must see the same ones.
    asking = stored(asking.withColumn("query", F.monotonically_increasing_id()), "queries")
    groups = max(1, -(-asking.count() // group))
    asking = asking.withColumn("group", F.pmod(F.xxhash64("query"), F.lit(groups)))
    asking = asking.withColumn("home", F.pmod(F.xxhash64("query", F.lit(1)), F.lit(shards)))
    trees = checkpointed(sharded(rows, shards))
    copies = trees.withColumn("group", F.explode(F.expr(f"sequence(0L, {groups - 1}L)")))
    ask = ["shard", "dim", "group", "query", "query_id", "v", "floor"]

    first = asking.withColumn("shard", F.col("home")).withColumn("floor", F.lit(None).cast("long"))
    found = stored(_searched(copies, first.select(ask), k), "first_shard")
    # With fewer than k rows in the first shard there is no k-th score yet.
    shared = found.groupBy("query").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    shared = shared.select("query", F.when(F.col("n") >= k, F.col("least")).alias("floor"))
    rest = asking.join(shared, "query", "left").withColumn(
        "shard", F.explode(F.expr(f"sequence(0L, {shards - 1}L)"))
    )
    more = _searched(copies, rest.where("shard <> home").select(ask), k)
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    best = found.unionByName(more).withColumn("rank", F.row_number().over(ranked))
    best = best.where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
