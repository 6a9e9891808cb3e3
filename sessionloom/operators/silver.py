"""Clean layer: complete, valid, typed events, one row per event id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.functions.contract import FIELDS, all_present, known_type
from sessionloom.functions.scalar import epoch_to_timestamp, event_clock

LOG_PLACE = ("kafka_partition", "kafka_offset")
ARRIVAL_ORDER = ("kafka_timestamp", *LOG_PLACE)


def clean(bronze: DataFrame) -> DataFrame:
    """Keep complete rows of a known type and add ``event_time``. Runs before the dedupe, so
    that a broken copy of an event never hides a good one."""
    return bronze.where(all_present() & known_type()).withColumn(
        "event_time", epoch_to_timestamp("timestamp")
    )


def dedupe(
    events: DataFrame,
    mode: str = "global",
    delay: str = "10 minutes",
    copy_salts: int | None = 0,
) -> DataFrame:
    """One row per ``event_id``, the one that arrived first.

    On a stream, rows at or behind the watermark (``delay`` behind the newest event time) are
    dropped; Spark needs ``event_time`` among the columns used later for that. Modes: ``global``
    remembers every id for good; ``within_watermark`` forgets an id once the watermark has
    passed it, so state stays bounded but a copy that comes later than that is kept.

    ``copy_salts``: a stream sends all copies of an id to one task. The default, 0, leaves it at
    that: dropping a copy costs one state lookup, and on the feeds measured that is cheaper than
    a second shuffle. For ids so hot that one task cannot read their copies, a first pass keyed
    by (id, salt) spreads them over that many tasks and lets one through from each; its state
    goes with the watermark. None takes as many salts as the query has state partitions. The
    salt is the record's place in the log, which the rows must then have. Salted or not is part
    of a checkpoint's state: to change it, start a fresh checkpoint.
    """
    if mode not in ("global", "within_watermark"):
        raise ValueError(f"unknown dedupe mode {mode!r}")
    if not events.isStreaming:
        return _first_arrivals(events)

    timed = events.withColumn("event_time", event_clock()).withWatermark("event_time", delay)
    if copy_salts is None:
        copy_salts = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if copy_salts > 1:
        salted = timed.withColumn("_salt", F.pmod(F.hash(*LOG_PLACE), F.lit(copy_salts)))
        timed = salted.dropDuplicatesWithinWatermark(["event_id", "_salt"]).drop("_salt")
    if mode == "global":
        return timed.dropDuplicates(["event_id"])
    return timed.dropDuplicatesWithinWatermark(["event_id"])


def _first_arrivals(events: DataFrame) -> DataFrame:
    """Batch form. Keeping rank 1 only makes Spark cut each partition down to one row per id
    before the shuffle, so an id with very many copies costs one row per input partition."""
    order = [c for c in ARRIVAL_ORDER if c in events.columns] or FIELDS[1:]
    first = Window.partitionBy("event_id").orderBy(*order)
    return events.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def to_silver(bronze: DataFrame, extra: Sequence[str] = (), **dedupe_options) -> DataFrame:
    """Bronze rows to silver rows, batch or stream. ``extra``: fields the contract has gained; they
    are carried along, required of no event and no part of the dedupe's state, so a stream takes
    them on without a new checkpoint."""
    return dedupe(clean(bronze), **dedupe_options).select(*FIELDS, *extra, "event_time")
