"""Session metrics over event-time windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from sessionloom.functions.scalar import event_clock, micros

# Metric columns and the event type each one counts.
COUNTED = {"page_views": "page_view", "cart_adds": "add_to_cart", "purchases": "purchase"}
METRICS = [*COUNTED, "revenue"]
# Slots of a key that are put in order together.
SEGMENT = 1024


def metric_aggregates() -> list[Column]:
    """The four metrics of a group of events. Gross: removals and searches change none."""
    is_type = {name: F.col("event_type") == kind for name, kind in COUNTED.items()}
    counts = [F.count_if(hit).alias(name) for name, hit in is_type.items()]
    paid = F.when(is_type["purchases"], F.col("price")).otherwise(0.0)
    return [*counts, F.sum(paid).alias("revenue")]


def session_metrics(
    silver: DataFrame, window: str = "5 minutes", delay: str = "2 minutes"
) -> DataFrame:
    """Metrics per session and tumbling window, batch or stream.

    Windows are [start, end) and aligned to the epoch. A stream emits a window once, when the
    watermark (``delay`` behind the newest event time) reaches its end; a batch emits all. Rows
    without an event time are in no window.
    """
    timed = silver.withColumn("event_time", event_clock())
    if silver.isStreaming:
        timed = timed.withWatermark("event_time", delay)
    return (
        timed.groupBy(F.window("event_time", window), "session_id")
        .agg(*metric_aggregates())
        .select(
            "session_id",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *METRICS,
        )
    )


def activity_windows(
    silver: DataFrame,
    gap: str = "30 minutes",
    delay: str = "2 minutes",
    key: str = "user_id",
    segment: int = SEGMENT,
) -> DataFrame:
    """Metrics per key and session window: events belong together while no pause between them
    is longer than ``gap``. A window ends ``gap`` after its last event; a pause of exactly
    ``gap`` does not end it.
    """
    timed = silver.withColumn("event_time", event_clock())
    if silver.isStreaming:
        return (
            timed.withWatermark("event_time", delay)
            .groupBy(F.session_window("event_time", gap), key)
            .agg(F.count("*").alias("events"), *metric_aggregates())
            .select(
                key,
                F.col("session_window.start").alias("window_start"),
                F.col("session_window.end").alias("window_end"),
                "events",
                *METRICS,
            )
        )
    return _merge_slots(_slot_totals(timed, gap, key), gap, key, segment)


def _slot_totals(timed: DataFrame, gap: str, key: str) -> DataFrame:
    """Totals per key and slot of one gap's length. Two events in one slot are less than a gap
    apart, so they always share a session window. This aggregate combines before its shuffle,
    and leaves a key no more rows than its time span has slots."""
    length = micros(gap)
    return (
        timed.where(F.col("event_time").isNotNull())
        .withColumn("_micros", F.unix_micros("event_time"))
        .withColumn("_slot", F.expr(f"(_micros - pmod(_micros, {length})) div {length}"))
        .groupBy(key, "_slot")
        .agg(
            F.min("_micros").alias("_first"),
            F.max("_micros").alias("_last"),
            F.count("*").alias("events"),
            *metric_aggregates(),
        )
    )


def _merge_slots(slots: DataFrame, gap: str, key: str, segment: int = SEGMENT) -> DataFrame:
    """Slots into windows. The slots of a key are put in order segment by segment, so a key with
    very many spreads over tasks. A window is whole where its segment ends, unless it is the first
    or last one there: those, at most two per segment, are then joined across segments."""
    length = micros(gap)
    by_time = ["_first"]
    segmented = slots.withColumn("_segment", F.expr(f"floor(_slot / {segment})"))
    inside = Window.partitionBy(key, "_segment").orderBy(*by_time)
    pieces = _runs(segmented, inside, length, [key, "_segment"])
    of_segment = Window.partitionBy(key, "_segment")
    # Pieces at a border go together per key, the others stay with their segment.
    nth, last = F.col("_nth"), F.max("_nth").over(Window.partitionBy(key, "_segment"))
    pieces = pieces.withColumn("_part", F.when((nth > 1) & (nth < last), F.col("_segment")))
    across = Window.partitionBy(key, "_part").orderBy(*by_time)
    return _runs(pieces, across, length, [key, "_part"]).select(
        key,
        F.timestamp_micros("_first").alias("window_start"),
        F.timestamp_micros(F.col("_last") + F.lit(length)).alias("window_end"),
        *["events", *METRICS],
    )


def _runs(rows: DataFrame, by_time: WindowSpec, length: int, keys: list[str]) -> DataFrame:
    """Rows no further apart than ``length`` folded into one, numbered in order as ``_nth``."""
    pause = F.col("_first") - F.lag("_last").over(by_time)
    numbered = rows.withColumn("_starts", F.when(pause <= length, 0).otherwise(1)).withColumn(
        "_nth", F.sum("_starts").over(by_time)
    )
    return numbered.groupBy(*keys, "_nth").agg(
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
        *[F.sum(name).alias(name) for name in ["events", *METRICS]],
    )
