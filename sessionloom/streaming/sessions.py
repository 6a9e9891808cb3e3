"""One current row per session, kept up to date by a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sessionloom.operators.funnel import funnel_of_sessions
from sessionloom.operators.gold import COUNTED, METRICS, metric_aggregates
from sessionloom.sources.delta import DeltaTableStore
from sessionloom.sources.files import numbered, read_if_there, remove
from sessionloom.sources.tables import SILVER_SCHEMA, Layout
from sessionloom.streaming.layers import start, stream_layer

STATE_SCHEMA = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("first_event", T.TimestampType()),
        T.StructField("last_event", T.TimestampType()),
        T.StructField("events", T.LongType()),
        *[T.StructField(name, T.LongType()) for name in COUNTED],
        T.StructField("revenue", T.DoubleType()),
    ]
)
# A stored row also holds the batch that changed it last.
MERGED_SCHEMA = T.StructType([*STATE_SCHEMA.fields, T.StructField("last_batch", T.LongType())])
BUCKET, VERSION = "bucket", "version"
STORED_SCHEMA = T.StructType(
    [*MERGED_SCHEMA.fields, T.StructField(BUCKET, T.LongType()), T.StructField(VERSION, T.LongType())]
)
MANIFEST = T.StructType([T.StructField("versions", T.ArrayType(T.LongType()))])
# Buckets of a new table.
BUCKETS = 64


def session_changes(silver_batch: DataFrame) -> DataFrame:
    """One row per session a batch of events touches."""
    return silver_batch.groupBy("session_id").agg(
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
        F.count("*").alias("events"),
        *metric_aggregates(),
    )


def summed(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of one session folded into one; ``keys`` are columns that go with the session."""
    return rows.groupBy(*keys, "session_id").agg(
        F.min("first_event").alias("first_event"),
        F.max("last_event").alias("last_event"),
        *[F.sum(name).alias(name) for name in ["events", *METRICS]],
        F.max("last_batch").alias("last_batch"),
    )


class SessionState:
    """Upserted session table on plain Parquet: one current row per session, read as it is.

    Sessions lie in hash buckets. A batch reads and rewrites the buckets it touches, under its own
    number (``bucket=b/version=n``), and then says in one small file, the manifest of the batch,
    which version of each bucket counts. Readers go by a manifest, so they see a batch whole or
    not at all, and a pinned batch stays as it was. A batch whose manifest is there is through: a
    retry changes nothing.

    ``buckets`` is fixed when the table is made; choose it so that a bucket fits a task (a few
    hundred MB). Versions that no batch from some number on needs go with ``expire``.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = buckets
        self._data = f"{self.path}/data"
        self._manifests = f"{self.path}/manifests"
        # Manifests read or written last; one that is complete never changes.
        self._known: dict[int, list[int]] = {}

    # -- manifests -------------------------------------------------------------------------

    def versions(self, batch_id: int | None = None) -> tuple[int, list[int]]:
        """(batch, version of each bucket) as of a batch, the newest by default; version -1 is an
        empty bucket. Before the first batch: (-1, all empty)."""
        if batch_id in self._known:
            return batch_id, self._known[batch_id]
        for found in reversed(numbered(self.spark, self._manifests, "batch_id")):
            if batch_id is None or found <= batch_id:
                if found in self._known:
                    return found, self._known[found]
                path = f"{self._manifests}/batch_id={found}"
                rows = read_if_there(self.spark, path, MANIFEST).collect()
                # A folder without a file is of a batch that was stopped.
                if rows:
                    return found, self._remember(found, rows[0]["versions"])
        return -1, [-1] * self.buckets

    def _remember(self, batch_id: int, versions: list[int]) -> list[int]:
        self._known[batch_id] = versions
        for old in sorted(self._known)[:-4]:
            del self._known[old]
        return versions

    def latest_version(self) -> int | None:
        batch, _ = self.versions()
        return None if batch < 0 else batch

    # -- writing ---------------------------------------------------------------------------

    def upsert(self, silver_batch: DataFrame, batch_id: int) -> None:
        found, versions = self.versions(batch_id)
        if found == batch_id:
            return
        number = F.pmod(F.xxhash64("session_id"), F.lit(len(versions)))
        changes = (
            session_changes(silver_batch)
            .withColumn("last_batch", F.lit(batch_id).cast("long"))
            .withColumn(BUCKET, number)
            .persist()
        )
        try:
            touched = [r[0] for r in changes.select(BUCKET).distinct().collect()]
            if touched:
                before = self._read({b: versions[b] for b in touched})
                rows = before.drop(VERSION).unionByName(changes)
                # Dealt by bucket, which also brings the rows of a session together.
                merged = summed(rows.repartition(BUCKET), BUCKET)
                (
                    merged.withColumn(VERSION, F.lit(batch_id).cast("long"))
                    .write.mode("overwrite")
                    .option("partitionOverwriteMode", "dynamic")
                    .partitionBy(BUCKET, VERSION)
                    .parquet(self._data)
                )
        finally:
            changes.unpersist()
        versions = [batch_id if b in set(touched) else v for b, v in enumerate(versions)]
        self._note(batch_id, versions)

    def _note(self, batch_id: int, versions: list[int]) -> None:
        """The manifest: one file, there at once or not at all."""
        row = self.spark.createDataFrame([(versions,)], MANIFEST).coalesce(1)
        row.write.mode("append").parquet(f"{self._manifests}/batch_id={batch_id}")
        self._remember(batch_id, versions)

    def expire(self, before: int) -> None:
        """Forget batches before a number: their manifests, and versions of buckets that no later
        batch reads. The newest batch stays."""
        first, needed = self.versions(before)
        if first < 0:
            return
        self._known = {first: needed}
        for batch in numbered(self.spark, self._manifests, "batch_id"):
            if batch < first:
                remove(self.spark, f"{self._manifests}/batch_id={batch}")
        for bucket in numbered(self.spark, self._data, BUCKET):
            folder = f"{self._data}/{BUCKET}={bucket}"
            for version in numbered(self.spark, folder, VERSION):
                if version < needed[bucket]:
                    remove(self.spark, f"{folder}/{VERSION}={version}")

    # -- reading ---------------------------------------------------------------------------

    def _path(self, bucket: int, version: int) -> str:
        return f"{self._data}/{BUCKET}={bucket}/{VERSION}={version}"

    def _read(self, versions: dict[int, int]) -> DataFrame:
        paths = [self._path(b, v) for b, v in versions.items() if v >= 0]
        if not paths:
            return self.spark.createDataFrame([], STORED_SCHEMA)
        return self.spark.read.schema(STORED_SCHEMA).option("basePath", self._data).parquet(*paths)

    def current(self, version: int | None = None) -> DataFrame:
        """One row per session, as stored: nothing is grouped."""
        found = dict(enumerate(self.versions(version)[1]))
        return self._read(found).select(STATE_SCHEMA.fieldNames())

    def query(self, version: int | None = None) -> str:
        """SQL for the current rows as of a batch, over the stored files: what
        ``sources.tables.publish`` makes a view of."""
        found = [(b, v) for b, v in enumerate(self.versions(version)[1]) if v >= 0]
        if not found:
            raise ValueError(f"no session in {self.path}")
        columns = ", ".join(STATE_SCHEMA.fieldNames())
        current = " OR ".join(f"{BUCKET} = {b} AND {VERSION} = {v}" for b, v in found)
        return f"SELECT {columns} FROM parquet.`{self._data}` WHERE {current}"

    def touched(self, batch_id: int) -> DataFrame:
        """All rows, with their bucket, of the buckets a batch has rewritten."""
        found, versions = self.versions(batch_id)
        if found != batch_id:
            raise ValueError(f"no batch {batch_id} in {self.path}")
        return self._read({b: v for b, v in enumerate(versions) if v == batch_id})

    def changes(self, batch_id: int) -> DataFrame:
        """(session_id, before, after) of the sessions a batch changed; before is null where it is
        new. Reads the buckets the batch touched, and says the same when asked again."""
        now = self.touched(batch_id).where(F.col("last_batch") == batch_id)
        old = self.versions(batch_id - 1)[1]
        versions = self.versions(batch_id)[1]
        then = self._read({b: old[b] for b, v in enumerate(versions) if v == batch_id})
        names = STATE_SCHEMA.fieldNames()
        return now.select("session_id", F.struct(*names).alias("after")).join(
            then.select("session_id", F.struct(*names).alias("before")), "session_id", "left"
        )

    def funnel(self, version: int | None = None) -> DataFrame:
        """The funnel as of a batch, straight from the session rows."""
        version = self.latest_version() if version is None else version
        return funnel_of_sessions(self.current(version), version)


class MergedSessionState:
    """The same table on Delta, where MERGE changes the touched rows in place."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = DeltaTableStore(spark, path, MERGED_SCHEMA)
        self.table.create()

    def upsert(self, silver_batch: DataFrame, batch_id: int) -> None:
        changes = session_changes(silver_batch).withColumn("last_batch", F.lit(batch_id).cast("long"))
        sums = {name: f"t.{name} + u.{name}" for name in ["events", *METRICS]}
        self.table.merge(
            changes,
            ["session_id"],
            {
                "first_event": "least(t.first_event, u.first_event)",
                "last_event": "greatest(t.last_event, u.last_event)",
                **sums,
                "last_batch": "u.last_batch",
            },
            only_if="t.last_batch < u.last_batch",
        )

    def current(self, version: int | None = None) -> DataFrame:
        return self.table.snapshot(version).drop("last_batch")

    def funnel(self, version: int | None = None) -> DataFrame:
        version = self.table.latest_version() if version is None else version
        return funnel_of_sessions(self.current(version), version)


def start_session_state(
    spark: SparkSession,
    layout: Layout,
    buckets: int = BUCKETS,
    max_files_per_trigger: int | None = None,
    **run,
) -> tuple[SessionState | MergedSessionState, StreamingQuery]:
    """Silver into the session table. The table is the state: the query itself keeps none."""
    checkpoint = layout.checkpoint("sessions")
    fmt = run.get("fmt", "parquet")
    state: SessionState | MergedSessionState
    if fmt == "delta":
        state = MergedSessionState(spark, layout.table("sessions"))
    else:
        state = SessionState(spark, layout.table("sessions"), buckets)
    silver = stream_layer(spark, layout, "silver", SILVER_SCHEMA, fmt, max_files_per_trigger)
    upsert: Callable[[DataFrame, int], None] = state.upsert
    return state, start(silver, checkpoint, each_batch=upsert, **run)
