"""Message-log records: Kafka, or files with the columns of Spark's Kafka source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.functions.contract import FIELDS

# Age beyond which a file stream may skip files and forget their names: a century.
MAX_FILE_AGE = "36500d"

BROKER_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)


def stream_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Topic as a stream, from its earliest offset unless told otherwise."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def stream_record_files(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
) -> DataFrame:
    """Directory of Parquet records as a stream, oldest file first.

    ``max_file_age``: files older than that beside the newest one taken are skipped for good.
    Wide by default, so that restored or back-filled files count; the query remembers the names
    of files no older than that.
    """
    reader = spark.readStream.schema(BROKER_SCHEMA).option("maxFileAge", max_file_age)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def encode_events(events: DataFrame, **others: Column) -> DataFrame:
    """Events to (key, value): session id bytes and the whole event as JSON bytes. Null fields
    are written as null, not left out. ``others`` are further columns of the records."""
    body = F.to_json(F.struct(*FIELDS), {"ignoreNullFields": "false"})
    return events.select(
        F.col("session_id").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        *[column.alias(name) for name, column in others.items()],
    )


def publish_kafka(records: DataFrame, servers: str, topic: str, checkpoint: str | None = None):
    """Send (key, value) records to a topic, as a batch or, given a checkpoint, as a stream."""
    if records.isStreaming:
        return (
            records.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .option("checkpointLocation", checkpoint)
            .start()
        )
    return (
        records.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
