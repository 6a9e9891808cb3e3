"""What the engine says of each micro-batch, kept as a table."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from sessionloom.sources.files import read_if_there
from sessionloom.sources.tables import Layout

PROGRESS_SCHEMA = T.StructType(
    [
        T.StructField("query_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("at", T.StringType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("watermark", T.StringType()),
        T.StructField("dropped_by_watermark", T.LongType()),
        T.StructField("state_rows", T.LongType()),
        T.StructField("batch_ms", T.LongType()),
    ]
)


def progress_row(progress: dict) -> tuple:
    """A row of the table from a progress report. Rows that are late are counted by each stateful
    step that refuses them."""
    state = progress.get("stateOperators") or []
    return (
        progress["id"],
        progress["runId"],
        progress.get("name"),
        progress["batchId"],
        progress["timestamp"],
        sum(source.get("numInputRows") or 0 for source in progress["sources"]),
        (progress.get("eventTime") or {}).get("watermark"),
        sum(step.get("numRowsDroppedByWatermark") or 0 for step in state),
        sum(step.get("numRowsTotal") or 0 for step in state),
        progress.get("batchDuration"),
    )


class ProgressLog(StreamingQueryListener):
    """Listener that writes a row per micro-batch of the session's queries to
    ``audit/progress``.

    Rows are written when ``every`` have come and when a query ends. A driver that dies loses the
    rows it still held, never any data: this is what was seen, the layers are what is true.
    """

    def __init__(self, spark: SparkSession, layout: Layout, every: int = 20):
        super().__init__()
        self.spark = spark
        self.path = progress_path(layout)
        self.every = every
        self._held: list[tuple] = []
        self._lock = threading.Lock()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        # Reports of queries that have ended may still be on their way.
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)
        self.flush()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._lock:
            self._held.append(progress_row(json.loads(event.progress.json)))
            full = len(self._held) >= self.every
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        with self._lock:
            rows, self._held = self._held, []
        if rows:
            made = self.spark.createDataFrame(rows, PROGRESS_SCHEMA)
            made.coalesce(1).write.mode("append").parquet(self.path)


def progress_path(layout: Layout) -> str:
    return layout.table("audit/progress")


def read_progress(spark: SparkSession, layout: Layout) -> DataFrame:
    """Reports of batches, each once: the last one where a batch was run again."""
    rows = read_if_there(spark, progress_path(layout), PROGRESS_SCHEMA)
    names = [name for name in PROGRESS_SCHEMA.fieldNames() if name not in ("query_id", "batch_id")]
    last = F.max_by(F.struct(*names), "at").alias("last")
    found = rows.groupBy("query_id", "batch_id").agg(last).select("query_id", "batch_id", "last.*")
    return found.select(*PROGRESS_SCHEMA.fieldNames())


def late_drops(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """One row: batches and rows a query has taken in, and the rows its stateful steps refused as
    late, by the engine's own count. Copies of events that were taken in before count as well."""
    rows = read_progress(spark, layout).where(F.col("name") == name)
    zero = F.lit(0).cast("long")
    return rows.agg(
        F.count("*").alias("batches"),
        F.coalesce(F.sum("rows_in"), zero).alias("rows_in"),
        F.coalesce(F.sum("dropped_by_watermark"), zero).alias("dropped"),
    )
