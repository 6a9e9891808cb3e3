"""Table written batch by batch, readable as of any batch beside its writer.

Plain partitioned Parquet. A batch is one partition, ``batch_id=n`` inside ``block=k``, written
with dynamic partition overwrite: a batch that is retried replaces itself. A reader pins a batch
number and filters on the partition column, so files of later batches are not read.

Compaction never touches what a stream writes. Batches are folded in blocks of a fixed number,
``[k * n, (k + 1) * n)``, once all of a block are committed, and n folds in turn into a larger
one. A fold is written under a name of its own and counts only from the moment its marker, one
small file written last, is there: readers plan from the markers, so they see all of a fold or
nothing of it, and one that was stopped half-way is made again under another name. Of two
compactions at once, whose folds hold the same rows, readers take one.

A read opens the largest folds that end before the pinned batch and the blocks of single batches
behind them; folded batches are not even listed. They stay for readers that pin one inside a fold
until ``expire`` removes them; what it has removed is refused, not answered short.

Where Delta is installed use ``DeltaTableStore``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.functions.scalar import utc_date
from sessionloom.sources.files import children, numbered, read_if_there, remove, stored_size

BATCH = "batch_id"
BLOCK = "block"
FOLD = "fold"
DATE = "event_date"
# Batches folded together. Part of the table's layout: the same for all who read and write it.
FOLD_EVERY = 100


class Fold(NamedTuple):
    """A marker: fold ``number`` of ``level`` holds ``fold_every ** level`` batches. Level 0 says
    instead that single batches before ``number`` were removed."""

    level: int
    # Number of the fold of the next level that takes this one in.
    parent: int
    number: int
    fold: str
    files_before: int
    bytes_before: int
    files_after: int
    bytes_after: int


MARKS = T.StructType(
    [
        T.StructField(name, T.StringType() if name == "fold" else T.LongType())
        for name in Fold._fields
    ]
)


class BatchTable:
    """``checkpoint``: of the stream that writes the table; its commits tell the newest complete
    batch. Without one, the newest partition does. ``clock``: the timestamp column whose UTC
    date the batches are partitioned by in turn, for reads of a time range. ``summed``: makes
    rows of several batches fewer without changing what readers make of them."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        checkpoint: str | None = None,
        clock: str | None = None,
        summed: Callable[[DataFrame], DataFrame] | None = None,
        fold_every: int = FOLD_EVERY,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.checkpoint = checkpoint
        self.clock = clock
        self.summed = summed or (lambda rows: rows)
        self.fold_every = fold_every
        self._batches = f"{self.path}/batches"
        self._folded = f"{self.path}/folded"
        self._marks = f"{self.path}/marks"

    def create(self) -> BatchTable:
        """For its writer: make the directory. Readers need none."""
        empty = self.spark.createDataFrame([], self._stored(BLOCK, BATCH))
        empty.write.mode("ignore").partitionBy(*self._keys(BLOCK, BATCH)).parquet(self._batches)
        return self

    def _keys(self, *parts: str) -> list[str]:
        return [*parts, DATE] if self.clock else [*parts]

    def _stored(self, *parts: str) -> T.StructType:
        kinds = {FOLD: T.StringType(), DATE: T.DateType()}
        fields = [T.StructField(k, kinds.get(k, T.LongType())) for k in self._keys(*parts)]
        return T.StructType([*self.schema.fields, *fields])

    # -- writing ---------------------------------------------------------------------------

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Rows of one batch, once, however often it is handed over. For ``foreachBatch``."""
        (
            self._dated(self._aligned(df))
            .withColumn(BLOCK, F.lit(batch_id // self.fold_every).cast("long"))
            .withColumn(BATCH, F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self._keys(BLOCK, BATCH))
            .parquet(self._batches)
        )

    def _aligned(self, df: DataFrame) -> DataFrame:
        return df.select([F.col(f.name).cast(f.dataType) for f in self.schema.fields])

    def _dated(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(DATE, utc_date(F.col(self.clock))) if self.clock else rows

    # -- reading ---------------------------------------------------------------------------

    def latest_version(self) -> int | None:
        """Newest batch that is complete, for the writer too."""
        if self.checkpoint is None:
            for block in reversed(numbered(self.spark, self._batches, BLOCK)):
                newest = self._single([(block * self.fold_every, None)], [block])
                if (last := newest.agg(F.max(BATCH)).first()[0]) is not None:
                    return last
            return None
        try:
            commits = self.spark.read.text(f"{self.checkpoint}/commits")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        names = commits.select("_metadata.file_name").where(F.col("file_name").rlike("^[0-9]+$"))
        return names.agg(F.max(F.col("file_name").cast("long"))).first()[0]

    def snapshot(
        self,
        version: int | None = None,
        since: datetime | None = None,
        until: datetime | None = None,
    ) -> DataFrame:
        """Rows of all batches up to one, the newest by default; of a time range ``[since,
        until)`` of the clock, if given. Later batches do not change it."""
        newest = self.latest_version()
        if version is None:
            version = newest
        elif newest is None or not 0 <= version <= newest:
            raise ValueError(f"no batch {version} in {self.path}")
        if version is None:
            return self.spark.createDataFrame([], self.schema)
        folds, ranges = self._plan(0, version)
        # With the date, which a time range is found by.
        parts = [self._single(ranges).drop(BLOCK, BATCH)] if ranges else []
        if folds:
            parts.append(self._read(self._folded, FOLD, folds).drop(FOLD))
        rows = reduce(DataFrame.unionByName, parts)
        if self.clock:
            rows = in_range(rows, self.clock, since, until)
        return rows.select(self.schema.fieldNames())

    def query(self, version: int | None = None) -> str:
        """SQL for the rows of all batches up to one, over the stored files: what ``publish`` makes
        a view of. It stays as it is until the files it names expire."""
        version = self.latest_version() if version is None else version
        if version is None:
            raise ValueError(f"no batch in {self.path}")
        folds, ranges = self._plan(0, version)
        columns = ", ".join(f"`{name}`" for name in self.schema.fieldNames())
        parts = []
        if folds:
            names = ", ".join(f"'{fold}'" for fold in folds)
            parts.append(f"SELECT {columns} FROM parquet.`{self._folded}` WHERE {FOLD} IN ({names})")
        if ranges:
            inside = " OR ".join(f"{BATCH} BETWEEN {low} AND {high}" for low, high in ranges)
            parts.append(f"SELECT {columns} FROM parquet.`{self._batches}` WHERE {inside}")
        return " UNION ALL ".join(parts)

    def added_rows(self, after: int, until: int | None = None) -> DataFrame:
        """Rows of the batches after one, up to another."""
        until = self.latest_version() if until is None else until
        if until is None or until <= after:
            return self.spark.createDataFrame([], self.schema)
        self._not_expired(after + 1, self.marks())
        return self._single([(after + 1, until)]).select(self.schema.fieldNames())

    def growth(self, since: int | None = None) -> DataFrame:
        """(version, rows_written) of every batch from ``since`` on that wrote any; by default of
        all that are still there singly."""
        marks = self.marks()
        first = _floor(marks) if since is None else since
        self._not_expired(first, marks)
        rows = self._single([(first, None)], numbered(self.spark, self._batches, BLOCK))
        return rows.groupBy(F.col(BATCH).alias("version")).agg(F.count("*").alias("rows_written"))

    def _plan(self, low: int, high: int) -> tuple[list[str], list[tuple[int, int]]]:
        """Folds that hold the batches ``[low, high]`` and the ranges of single batches between."""
        marks = self.marks()
        made = {(m.level, m.number): m for m in marks if m.level}
        largest = max((m.level for m in marks), default=0)
        folds: list[str] = []
        ranges: list[tuple[int, int]] = []
        at = low
        while at <= high:
            for level in range(largest, 0, -1):
                size = self.fold_every**level
                if at % size == 0 and at + size - 1 <= high and (level, at // size) in made:
                    folds.append(made[level, at // size].fold)
                    at += size
                    break
            else:
                end = min(high, at - at % self.fold_every + self.fold_every - 1)
                if ranges and ranges[-1][1] == at - 1:
                    ranges[-1] = (ranges[-1][0], end)
                else:
                    ranges.append((at, end))
                at = end + 1
        for first, _ in ranges:
            self._not_expired(first, marks)
        return folds, ranges

    def _not_expired(self, batch: int, marks: list[Fold]) -> None:
        if batch < (floor := _floor(marks)):
            raise ValueError(f"single batches before {floor} were removed from {self.path}")

    def _single(
        self, ranges: list[tuple[int, int | None]], blocks: list[int] | None = None
    ) -> DataFrame:
        """Rows of ranges of single batches, with their partition columns. Only directories of
        the blocks they are in are listed."""
        if blocks is None:
            there = set(numbered(self.spark, self._batches, BLOCK))
            wanted = {b for a, z in ranges for b in range(a // self.fold_every, z // self.fold_every + 1)}
            blocks = sorted(wanted & there)
        rows = self._read(self._batches, BLOCK, [str(b) for b in blocks], BATCH)
        batch = F.col(BATCH)
        inside = [batch >= a if z is None else batch.between(a, z) for a, z in ranges]
        return rows.where(reduce(Column.__or__, inside))

    def _read(self, base: str, part: str, values: list[str], *more: str) -> DataFrame:
        """Rows of some directories ``part=value`` of a base, with their partition columns."""
        schema = self._stored(part, *more)
        if not values:
            return self.spark.createDataFrame([], schema)
        paths = [f"{base}/{part}={value}" for value in values]
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths)

    def marks(self) -> list[Fold]:
        """Markers of the complete folds, one each."""
        found = [Fold(**r.asDict()) for r in read_if_there(self.spark, self._marks, MARKS).collect()]
        return sorted({(m.level, m.number): m for m in sorted(found, reverse=True)}.values())

    # -- layout ----------------------------------------------------------------------------

    def compact(self, cluster_by: list[str], file_bytes: int = 256 * 1024 * 1024) -> list[Fold]:
        """Fold what is complete and not folded yet into sorted files of about ``file_bytes``;
        returns the folds made, with the files and bytes read and written. A row is rewritten
        once per level."""
        newest = self.latest_version()
        made: list[Fold] = []
        level, size = 1, self.fold_every
        while newest is not None and newest + 1 >= size:
            marks = self.marks()
            for number in range((newest + 1) // size):
                if not any(m.level >= level and _inside(number, level, m, self.fold_every) for m in marks):
                    made.append(self._fold(level, number, marks, cluster_by, file_bytes))
            if self.fold_every == 1:
                break
            level, size = level + 1, size * self.fold_every
        return made

    def _fold(
        self, level: int, number: int, marks: list[Fold], cluster_by: list[str], file_bytes: int
    ) -> Fold:
        low = number * self.fold_every
        if level == 1:
            self._not_expired(low, marks)
            rows = self._single([(low, low + self.fold_every - 1)])
        else:
            parts = [m.fold for m in marks if m.level == level - 1 and m.number // self.fold_every == number]
            rows = self._read(self._folded, FOLD, parts)
        files_before, bytes_before = stored_size(rows)
        files = max(1, -(-bytes_before // file_bytes))
        smaller = self.summed(rows.select(self.schema.fieldNames()))
        name = f"{level}-{number}-{uuid.uuid4().hex}"
        clustered = self._dated(cluster(self._aligned(smaller), cluster_by, files))
        path = f"{self._folded}/{FOLD}={name}"
        clustered.write.partitionBy(*self._keys()).parquet(path)
        after = stored_size(self._read(self._folded, FOLD, [name]))
        fold = Fold(level, number // self.fold_every, number, name, files_before, bytes_before, *after)
        self._mark(fold)
        return fold

    def _mark(self, fold: Fold) -> None:
        """One file, and so there at once or not at all."""
        row = self.spark.createDataFrame([fold], MARKS).coalesce(1)
        row.write.mode("append").partitionBy("level", "parent").parquet(self._marks)

    def expire(self, before: int, orphans: bool = False) -> int:
        """Remove single batches before a number, as far as they are folded, and folds that a
        larger one holds; returns the first batch that is still there singly. From then on pins
        inside removed folds are refused. Give readers time to end that began before the folds
        were made. ``orphans``: folds without a marker too; not while a compaction runs."""
        marks = self.marks()
        done = {(m.level, m.number) for m in marks}
        end = 0
        while any((m.level and _inside(end, 1, m, self.fold_every)) for m in marks):
            end += 1
        floor = max(_floor(marks), min(before // self.fold_every, end) * self.fold_every)
        if floor > _floor(marks):
            # Said first: from here on nobody plans to read what is about to go.
            self._mark(Fold(0, 0, floor, "", 0, 0, 0, 0))
        for block in numbered(self.spark, self._batches, BLOCK):
            if (block + 1) * self.fold_every <= floor:
                remove(self.spark, f"{self._batches}/{BLOCK}={block}")
        for mark in marks:
            held = mark.level and (mark.level + 1, mark.parent) in done
            if held and (mark.number + 1) * self.fold_every**mark.level <= floor:
                remove(self.spark, f"{self._marks}/level={mark.level}/parent={mark.parent}")
                remove(self.spark, f"{self._folded}/{FOLD}={mark.fold}")
        if orphans:
            named = {m.fold for m in self.marks()}
            for name in children(self.spark, self._folded):
                if name.startswith(f"{FOLD}=") and name.removeprefix(f"{FOLD}=") not in named:
                    remove(self.spark, f"{self._folded}/{name}")
        return floor


def _floor(marks: list[Fold]) -> int:
    return max((m.number for m in marks if m.level == 0), default=0)


def _inside(number: int, level: int, mark: Fold, every: int) -> bool:
    """Whether a mark of this level or a higher one holds fold ``number`` of ``level``."""
    return mark.level >= level and number // every ** (mark.level - level) == mark.number


def in_range(
    rows: DataFrame, clock: str, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """Rows with ``since <= clock < until``, by partition date first, so that other dates are
    not read. Without bounds, all rows, those without a time too."""
    if since is not None:
        rows = rows.where((F.col(DATE) >= utc_date(F.lit(since))) & (F.col(clock) >= F.lit(since)))
    if until is not None:
        rows = rows.where((F.col(DATE) <= utc_date(F.lit(until))) & (F.col(clock) < F.lit(until)))
    return rows


def cluster(df: DataFrame, cluster_by: list[str], files: int) -> DataFrame:
    """Range-partition and sort by columns. The row's hash closes the range key, so that rows
    sharing one value, however many, still spread over several files."""
    keys: list[Column] = [F.col(c) for c in cluster_by]
    return df.repartitionByRange(files, *keys, F.xxhash64(*df.columns)).sortWithinPartitions(*keys)
