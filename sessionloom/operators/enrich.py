"""Stream or batch of events joined to a product catalogue."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024


def text_bytes(df: DataFrame) -> int:
    """Size of a table's rows as JSON text: one pass, one number to the driver."""
    row = F.octet_length(F.to_json(F.struct("*")))
    return df.agg(F.coalesce(F.sum(row), F.lit(0)).alias("bytes")).first()["bytes"]


def enrich(
    events: DataFrame,
    catalog: DataFrame,
    on: str = "product_id",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join of a batch of events to a catalogue with one row per ``on``; unmatched events
    keep nulls.

    The catalogue is measured first. Up to ``broadcast_bytes`` it is broadcast and the events
    do not move. Beyond that both sides are shuffled by key and the events of a key that turns
    out hot are split over several tasks at run time (adaptive skew join), each with that key's
    one catalogue row; other keys travel once.
    """
    if events.isStreaming:
        raise ValueError("measure the catalogue per batch: see enrich_batches")
    if text_bytes(catalog) <= broadcast_bytes:
        return events.join(F.broadcast(catalog), on, "left")
    return events.join(catalog.hint("shuffle_merge"), on, "left")


def enrich_batches(
    catalog: Callable[[], DataFrame],
    write: Callable[[DataFrame, int], None],
    on: str = "product_id",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch``: joins each micro-batch to the catalogue as it is then,
    measured anew, and hands the result to ``write``."""

    def run(batch: DataFrame, batch_id: int) -> None:
        write(enrich(batch, catalog(), on, broadcast_bytes), batch_id)

    return run
