"""What running queries hold in their state, read from their checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.operators.gold import COUNTED, METRICS
from sessionloom.sources.tables import Layout


def read_state(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """(key, value, partition_id) of a stateful step as of the newest committed batch; the running
    query is not disturbed."""
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint)


def open_windows(spark: SparkSession, layout: Layout) -> DataFrame:
    """Windows of sessions that gold has not emitted yet, with their metrics so far."""
    state = read_state(spark, layout.checkpoint("gold"))
    # The aggregates' buffers come in the order the metrics are made in; several share a name.
    buffers = state.schema["value"].dataType.fields
    names = [f"_{i}" for i in range(len(buffers) - len(METRICS))] + METRICS
    named = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, buffers, strict=True)])
    value = F.col("value").cast(named)
    return state.select(
        F.col("key.session_id").alias("session_id"),
        F.col("key.window.start").alias("window_start"),
        F.col("key.window.end").alias("window_end"),
        *[value[name].alias(name) for name in METRICS],
    )


def remembered_ids(spark: SparkSession, layout: Layout) -> DataFrame:
    """Event ids the dedupe of silver would refuse."""
    state = read_state(spark, layout.checkpoint("silver"))
    return state.select(F.col("key.event_id").alias("event_id"))


def state_audit(spark: SparkSession, layout: Layout) -> DataFrame:
    """One row: open windows, the events they count, and the ids remembered."""
    counted = [F.sum(name) for name in COUNTED]
    windows = open_windows(spark, layout).agg(
        F.count("*").alias("open_windows"),
        F.coalesce(sum(counted[1:], counted[0]), F.lit(0)).alias("events_in_open_windows"),
    )
    ids = remembered_ids(spark, layout).agg(F.count("*").alias("remembered_ids"))
    return windows.select("*", ids.scalar().alias("remembered_ids"))
