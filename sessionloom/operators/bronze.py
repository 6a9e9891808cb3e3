"""Raw layer: broker records with their event parsed beside the text, nothing dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.functions.contract import event_schema


def decode_records(records: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Broker records to bronze rows, batch or stream.

    A value that is not valid JSON, or has a field of the wrong type, gives nulls; its row and
    its text stay. No shuffle, no state.
    """
    schema = schema or event_schema(strict=False)
    broker = {
        "kafka_partition": "partition",
        "kafka_offset": "offset",
        "kafka_timestamp": "timestamp",
    }
    # Unpacked by a generator, not by field access: a later filter on the fields then stays
    # above the parse. Pushed below it, every single condition would parse the text again.
    return records.select(
        *[F.col(source).alias(name) for name, source in broker.items()],
        F.col("value").cast("string").alias("raw_value"),
    ).select("*", F.inline_outer(F.array(F.from_json("raw_value", schema))))
