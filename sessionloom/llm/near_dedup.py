"""Near-duplicate documents: fast similarity sketches, banding, exact verification.

1. A document is its set of distinct ``shingle``-word runs. Documents with equal sets form a
   class; one document, the smallest id, stands for it.
2. Sketch. Round after round every shingle is hashed to a bin and a value, and a bin keeps the
   least value of the first round that hit it; a second set of rounds visits every bin, so all
   coordinates fill. Two sketches agree in a coordinate with the probability of the Jaccard
   similarity.
3. Bands. Documents that agree in all coordinates of a band share a bucket. With 44 bands of 8
   a pair at similarity 0.85 shares none with probability 9e-7, less above.
4. Links. Each bucket's members are compared with its smallest on their full sets, and
   components are taken. Buckets whose members still lie in different components are then
   settled in tiles: all members of such buckets are compared across components, exactly.
   Pairs inside a component cannot change anything.

Buckets have no cap. Copies never meet pair by pair: classes take equal sets first, and near
copies mostly go through the smallest member of a bucket. What is left over is compared in
tiles of bounded size, whose number grows with the square of what is left over of one cluster.

Defined results: null, empty and blank texts have no shingles and are linked with nothing, as
are rows with a null id; a text of fewer words than a shingle is one shingle; rows that share
an id are one node; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.common import release, releasing, stored
from sessionloom.llm.components import components
from sessionloom.llm.textscan import Words, gathered, mixed, prefix_hash, range_hash

SHINGLE = 5
BANDS = 44
ROWS = 8
# Similarity in percent from which documents are linked.
PERCENT = 85
# Members and compressed text of a tile, two of which are compared by one task.
TILE_TEXTS = 1024
TILE_BYTES = 4 << 20

_EMPTY = np.uint64((1 << 64) - 1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
SKETCH = (
    "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>"
)


def shingles(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct shingles, by text, then hash."""
    words = Words([t.lower() for t in texts])
    n = words.per_doc()
    first = np.cumsum(n) - n
    at = np.arange(len(words.starts))
    begin = at[at + size <= (first + n)[words.doc]]
    short = np.flatnonzero((n > 0) & (n < size))
    start = np.concatenate((begin, first[short]))
    last = np.concatenate((begin + size - 1, (first + n)[short] - 1))
    hashes = range_hash(prefix_hash(words.data), words.starts[start], words.ends[last])
    owner = words.doc[start]
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return owner[new], hashes[new]


def sketches(owner: np.ndarray, hashes: np.ndarray, n: int, size: int) -> np.ndarray:
    """One row of ``size`` coordinates per text; rows of texts without shingles stay empty."""
    table = np.full(n * size, _EMPTY)
    for turn in range(2 * size):
        if not len(owner):
            break
        x = mixed(hashes + np.uint64((turn + 1) * int(_STEP) & (1 << 64) - 1))
        if turn < size:
            bins = ((x >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        else:
            bins = turn - size
        value = (x & np.uint64(0xFFFFFFFF)) | np.uint64(turn << 32)
        np.minimum.at(table, owner * size + bins, value)
        # Only texts with an empty bin go on.
        open_texts = np.unique(owner)
        full = (table.reshape(n, size)[open_texts] != _EMPTY).all(axis=1)
        if full.any():
            done = np.zeros(n, bool)
            done[open_texts[full]] = True
            keep = ~done[owner]
            owner, hashes = owner[keep], hashes[keep]
    return table.reshape(n, size)


def band_keys(table: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = table.reshape(len(table), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(table), bands)).copy()
    for k in range(rows):
        key = mixed(key * _STEP + parts[:, :, k])
    return key.view(np.int64)


def _sketch(shingle: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"]
            texts = [t or b"" for t in batch["text"].cast(pa.binary()).to_pylist()]
            for at, some in gathered(texts, 2 << 20):
                owner, hashes = shingles(some, shingle)
                n = np.bincount(owner, minlength=len(some))
                sums = [np.zeros(len(some), np.uint64) for _ in range(2)]
                for k, total in enumerate(sums):
                    np.add.at(total, owner, mixed(hashes ^ np.uint64(k + 1)))
                keys = band_keys(sketches(owner, hashes, len(some), bands * rows), bands, rows)
                offsets = np.arange(len(some) + 1, dtype=np.int32) * bands
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(at, len(some)),
                        pa.array(n.astype(np.int64)),
                        pa.array(sums[0].view(np.int64)),
                        pa.array(sums[1].view(np.int64)),
                        lists,
                    ],
                    ["doc_id", "n_shingles", "set_a", "set_b", "bands"],
                )

    return run


def _packed_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = [squeeze.compress(t or b"") for t in batch["text"].cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["id"], pa.array(texts, pa.binary())], ["id", "body"])


def _similar(shingle: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_text = zstandard.ZstdDecompressor().decompress
        for whole in batches:
            # Few enough pairs at once that their texts fit.
            for begin in range(0, whole.num_rows, 256):
                batch = whole.slice(begin, 256)
                bodies: dict[bytes, int] = {}
                sides = [
                    [bodies.setdefault(b, len(bodies)) for b in batch[name].to_pylist()]
                    for name in ("body_a", "body_b")
                ]
                sets: list[np.ndarray] = []
                for _, some in gathered(open_text(b) for b in bodies):
                    owner, hashes = shingles(some, shingle)
                    sets += np.split(hashes, np.searchsorted(owner, np.arange(1, len(some))))
                linked = []
                for x, y in zip(*sides, strict=True):
                    a, b = sets[x], sets[y]
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    linked.append(100 * common >= percent * (len(a) + len(b) - common))
                mask = pa.array(linked, pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [batch["a"].filter(mask), batch["b"].filter(mask)], ["a", "b"]
                )

    return run


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    left = texts.select(F.col("id").alias("a"), F.col("body").alias("body_a"))
    right = texts.select(F.col("id").alias("b"), F.col("body").alias("body_b"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    checked = joined.select("a", "b", "body_a", "body_b")
    return checked.mapInArrow(releasing(_similar(shingle, percent)), "a bigint, b bigint").distinct()


def _settled(rest: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs of components with linked members that share a bucket.

    ``rest``: (key, id, component, first) of unsettled buckets. Buckets that share members form
    a cluster, whose members travel once, not once per bucket. A cluster is cut into tiles of
    bounded text; a task gets two tiles, compares their sets exactly, and returns no more pairs
    than join the components it found linked, so rows stay in proportion to members.
    """
    clusters = components(rest.select(F.col("first").alias("a"), F.col("id").alias("b")))
    member = rest.select("id", "component").distinct().join(clusters.withColumnRenamed("component", "cluster"), "id")
    bodies = member.join(texts, "id").select("cluster", "id", "component", "body")
    sizes = bodies.groupBy("cluster").agg(
        F.greatest(
            F.ceil(F.count("*") / F.lit(TILE_TEXTS)),
            F.ceil(F.sum(F.octet_length("body")) / F.lit(TILE_BYTES)),
        ).alias("tiles")
    )
    tiled = bodies.join(sizes, "cluster").withColumn("tile", F.expr("pmod(xxhash64(id), tiles)"))
    tasks = tiled.withColumn("other", F.explode(F.expr("sequence(0L, tiles - 1)"))).select(
        "cluster",
        F.least("tile", "other").alias("low"),
        F.greatest("tile", "other").alias("high"),
        "tile",
        "id",
        "component",
        "body",
    )
    # Rows are dealt by cluster here, which would do for the groups: deal them by pair of tiles,
    # or all tiles of a cluster were compared in one task.
    dealt = tasks.repartition("cluster", "low", "high")
    return dealt.groupBy("cluster", "low", "high").applyInArrow(
        _compare_tiles(shingle, percent), "a bigint, b bigint"
    )


def _compare_tiles(shingle: int, percent: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        low, high = key[1].as_py(), key[2].as_py()
        open_text = zstandard.ZstdDecompressor().decompress
        owners, hashes = [], []
        for at, some in gathered(open_text(b.as_py()) for b in rows["body"]):
            owner, found = shingles(some, shingle)
            owners.append(owner + at)
            hashes.append(found)
        owner, found = np.concatenate(owners), np.concatenate(hashes)
        n = np.bincount(owner, minlength=rows.num_rows)
        tile = rows["tile"].to_numpy()
        left = np.flatnonzero(tile == low)
        right = np.flatnonzero(tile == high)
        place = np.zeros(rows.num_rows, np.int64)
        place[right] = np.arange(len(right))
        place_left = np.zeros(rows.num_rows, np.int64)
        place_left[left] = np.arange(len(left))
        common = np.zeros((len(left), len(right)), np.int32)
        order = np.argsort(found, kind="stable")
        owner, found = owner[order], found[order]
        cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
        begins, ends = np.append(0, cuts), np.append(cuts, len(found))
        several = ends - begins > 1
        for a, b in zip(begins[several].tolist(), ends[several].tolist(), strict=True):
            who = owner[a:b]
            x, y = who[tile[who] == low], who[tile[who] == high]
            if len(x) and len(y):
                common[np.ix_(place_left[x], place[y])] += 1
        total = n[left][:, None] + n[right][None, :] - common
        part = rows["component"].to_numpy()
        linked = (100 * common.astype(np.int64) >= percent * total) & (common > 0)
        linked &= part[left][:, None] != part[right][None, :]
        release()
        return _forest(part, left, right, np.argwhere(linked))

    return run


def _forest(part: np.ndarray, left: np.ndarray, right: np.ndarray, pairs: np.ndarray) -> pa.Table:
    """Pairs of components that are linked, no more than it takes to join them."""
    top: dict[int, int] = {}

    def root(x: int) -> int:
        while top.get(x, x) != x:
            x = top[x]
        return x

    a, b = [], []
    for i, j in pairs.tolist():
        x, y = root(int(part[left[i]])), root(int(part[right[j]]))
        if x != y:
            top[max(x, y)] = min(x, y)
            a.append(int(part[left[i]]))
            b.append(int(part[right[j]]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    plain = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    sketched = stored(plain.mapInArrow(releasing(_sketch(shingle, bands, rows)), SKETCH), "sketches")
    whole_set = ["n_shingles", "set_a", "set_b"]
    some = sketched.where("n_shingles > 0 and doc_id is not null")
    classes = some.groupBy(*whole_set).agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands")
    )
    # (band key, member, its set size, smallest member of the bucket) of buckets with several.
    entries = classes.select(
        F.col("rep").alias("id"), F.col("n_shingles").alias("n"), F.explode("bands").alias("key")
    )
    pivots = (
        entries.groupBy("key")
        .agg(F.min(F.struct("id", "n")).alias("pivot"), F.max("id").alias("last"))
        .where("last <> pivot.id")
        .select("key", "pivot")
    )
    members = stored(
        entries.join(pivots, "key").select(
            "key", "id", "n", F.col("pivot.id").alias("pivot"), F.col("pivot.n").alias("pivot_n")
        ),
        "members",
    )
    # Sets of too different sizes cannot be that similar.
    sizes = f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"
    first = stored(
        members.where("id <> pivot")
        .select(
            F.col("pivot").alias("a"), F.col("id").alias("b"),
            F.col("pivot_n").alias("n_a"), F.col("n").alias("n_b"),
        )
        .where(sizes)
        .select("a", "b")
        .distinct(),
        "pairs",
    )
    # Dealt by id at every size, not sent to all while it happens to be small.
    wanted = members.select("id").distinct().hint("merge")
    bodies = (
        plain.select(F.col("doc_id").alias("id"), "text")
        .join(wanted, "id", "left_semi")
        .mapInArrow(_packed_text, "id bigint, body binary")
    )
    texts = stored(bodies, "texts")
    links = stored(_verified(first, texts, shingle, percent), "links")
    found = components(links)
    # What shares a bucket and is not yet connected is compared in full.
    placed = members.join(found, "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("component")
    )
    unsettled = (
        placed.groupBy("key")
        .agg(F.min("id").alias("first"), F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("key", "first")
    )
    rest = stored(placed.join(unsettled, "key"), "unsettled")
    more = stored(_settled(rest, texts, shingle, percent), "more_links")
    # Components of components: what the first links have joined is settled.
    if not more.isEmpty():
        merged = components(more)
        found = stored(
            found.select("id", "component")
            .join(merged.select(F.col("id").alias("component"), F.col("component").alias("top")), "component", "left")
            .select("id", F.coalesce("top", "component").alias("component"))
            .union(merged.join(found, "id", "left_anti")),
            "components",
        )
    # Back to every document by its class. Stored, so that both sides of the join are dealt by
    # set and a class with very many copies is split by the skew join.
    named = classes.select(*whole_set, "rep").join(found.withColumnRenamed("id", "rep"), "rep", "left")
    classes = stored(
        named.select(*whole_set, F.coalesce("component", "rep").alias("component_id")), "classes"
    )
    own = sketched.where("n_shingles > 0 and doc_id is not null").drop("bands")
    alone = sketched.where("n_shingles = 0 or doc_id is null")
    return (
        own.join(classes, whole_set)
        .select("doc_id", "n_shingles", "component_id")
        .union(alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
        .select("*", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )
