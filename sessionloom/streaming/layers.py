"""Streaming queries of the layers. Each reads the layer below and restarts on its own."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sessionloom.functions.contract import event_schema
from sessionloom.operators.bronze import decode_records
from sessionloom.operators.gold import session_metrics
from sessionloom.operators.silver import to_silver
from sessionloom.session import STATE_DEFAULTS, conf_overrides
from sessionloom.sources.batches import DATE, BatchTable
from sessionloom.sources.broker import MAX_FILE_AGE
from sessionloom.sources.tables import (
    CLOCKS,
    GOLD_SCHEMA,
    SILVER_SCHEMA,
    Layout,
    bronze_schema,
    dated,
    stream_table,
    with_date,
)

# Trigger of a run that takes in what is there and ends.
ONCE = {"availableNow": True}


def state_settings(partitions: int | None) -> dict[str, str]:
    """Settings a stateful query is started under. Its number of state partitions is fixed by
    its first run; later runs keep it whatever is passed."""
    if partitions:
        return {**STATE_DEFAULTS, "spark.sql.shuffle.partitions": str(partitions)}
    return STATE_DEFAULTS


def start(
    rows: DataFrame,
    checkpoint: str,
    path: str | None = None,
    each_batch: Callable[[DataFrame, int], None] | None = None,
    fmt: str = "parquet",
    trigger: Mapping | None = None,
    state_partitions: int | None = None,
    name: str | None = None,
    merge_schema: bool = False,
    partition_by: str | None = None,
) -> StreamingQuery:
    """Start a query that appends to a table directory or hands each batch to a function.

    ``trigger`` is passed to ``writeStream.trigger``; without one, batches follow each other
    until the query is stopped. ``merge_schema`` lets a Delta table take on new columns; Parquet
    directories need no leave for that.
    """
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    if merge_schema:
        writer = writer.option("mergeSchema", "true")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with conf_overrides(rows.sparkSession, state_settings(state_partitions)):
        if each_batch is not None:
            return writer.foreachBatch(each_batch).start()
        return writer.format(fmt).start(path)


def start_bronze(
    records: DataFrame,
    layout: Layout,
    schema: T.StructType | None = None,
    extra: list[T.StructField] | None = None,
    **run,
) -> StreamingQuery:
    """Broker records into bronze. ``records`` is a Kafka or record-file stream; ``extra`` are
    fields the contract has gained."""
    schema = schema or event_schema(strict=False, extra=extra)
    return start(
        dated(decode_records(records, schema), CLOCKS["bronze"]),
        layout.checkpoint("bronze"),
        layout.table("bronze"),
        partition_by=DATE,
        **run,
    )


def start_silver(
    spark: SparkSession,
    layout: Layout,
    dedupe: Mapping | None = None,
    max_files_per_trigger: int | None = None,
    extra: list[T.StructField] | None = None,
    max_file_age: str = MAX_FILE_AGE,
    **run,
) -> StreamingQuery:
    """Bronze into silver; ``dedupe`` holds options of ``operators.silver.dedupe``, ``extra`` the
    fields the contract has gained. A query may be restarted on its checkpoint with more.
    ``max_file_age``: as for ``stream_table``; the source log keeps names no longer than that."""
    fmt = run.get("fmt", "parquet")
    schema = bronze_schema(extra)
    bronze = stream_layer(
        spark, layout, "bronze", schema, fmt, max_files_per_trigger, max_file_age
    )
    with conf_overrides(spark, state_settings(run.get("state_partitions"))):
        silver = to_silver(bronze, [field.name for field in extra or []], **(dedupe or {}))
    return start(
        dated(silver, CLOCKS["silver"]),
        layout.checkpoint("silver"),
        layout.table("silver"),
        partition_by=DATE,
        **run,
    )


def stream_layer(
    spark: SparkSession,
    layout: Layout,
    layer: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
) -> DataFrame:
    """Bronze or silver as a stream of its new rows."""
    stored = with_date(schema)
    path = layout.table(layer)
    rows = stream_table(spark, path, stored, fmt, max_files_per_trigger, max_file_age)
    return rows.select(schema.fieldNames())


def gold_table(spark: SparkSession, layout: Layout) -> BatchTable:
    return BatchTable(
        spark, layout.table("gold"), GOLD_SCHEMA, layout.checkpoint("gold"), CLOCKS["gold"]
    )


def start_gold(
    spark: SparkSession,
    layout: Layout,
    window: str = "5 minutes",
    delay: str = "2 minutes",
    max_files_per_trigger: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
    **run,
) -> StreamingQuery:
    """Silver into gold. Gold keeps its batches apart, so that a reader can pin what it reads;
    with ``fmt="delta"`` the table itself has versions."""
    fmt = run.get("fmt", "parquet")
    silver = stream_layer(
        spark, layout, "silver", SILVER_SCHEMA, fmt, max_files_per_trigger, max_file_age
    )
    metrics = session_metrics(silver, window, delay)
    checkpoint = layout.checkpoint("gold")
    if fmt == "delta":
        return start(metrics, checkpoint, layout.table("gold"), **run)
    table = gold_table(spark, layout).create()
    return start(metrics, checkpoint, each_batch=table.write, **run)


def run_all(spark: SparkSession, records: DataFrame, layout: Layout, **run) -> None:
    """Take in what has arrived, layer by layer, and end."""
    run = {"trigger": ONCE, **run}
    start_bronze(records, layout, **run).awaitTermination()
    start_silver(spark, layout, **run).awaitTermination()
    start_gold(spark, layout, **run).awaitTermination()
