"""Contract check in front of the topic: good events go on, the others to a quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sessionloom.functions.contract import check_contract, violation_text
from sessionloom.sources.batches import BATCH
from sessionloom.sources.broker import publish_kafka
from sessionloom.sources.tables import Layout
from sessionloom.streaming.layers import start

RECORDS = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("reason", T.StringType()),
        T.StructField("accepted", T.BooleanType()),
    ]
)


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("violations") == 0)


def rejected(checked: DataFrame) -> DataFrame:
    """Refused rows with the reason, and session and type as far as the text has them."""
    return checked.where(F.size("violations") > 0).select(
        "*",
        violation_text().alias("reason"),
        F.get_json_object("raw_value", "$.session_id").alias("session_id"),
        F.get_json_object("raw_value", "$.event_type").alias("event_type"),
    )


def counted(checked: DataFrame, name: str = "contract") -> DataFrame:
    """Same rows; the query's progress then reports ``sent`` and ``rejected`` under ``name``."""
    return checked.observe(name, *_counters())


def split_counts(checked: DataFrame) -> DataFrame:
    """One row: how many were sent and how many rejected."""
    return checked.agg(*_counters())


def _counters():
    bad = F.size("violations") > 0
    return [F.count_if(~bad).alias("sent"), F.count_if(bad).alias("rejected")]


def checked_records(checked: DataFrame) -> DataFrame:
    """Checked events as records keyed by session, with the side they go to."""
    return checked.select(
        F.get_json_object("raw_value", "$.session_id").cast("binary").alias("key"),
        F.col("raw_value").cast("binary").alias("value"),
        violation_text().alias("reason"),
        (F.size("violations") == 0).alias("accepted"),
    )


def publish_checked(raw: DataFrame, path: str) -> None:
    """Check JSON events (column ``raw_value``) and write them in one pass, keyed by session,
    as ``accepted=true`` (records for the topic) and ``accepted=false`` (quarantine)."""
    records = checked_records(check_contract(raw))
    records.write.mode("overwrite").partitionBy("accepted").parquet(path)


def start_publish(
    raw: DataFrame,
    layout: Layout,
    servers: str | None = None,
    topic: str | None = None,
    **run,
) -> StreamingQuery:
    """Stream of JSON events (``raw_value``) through the contract, in one pass per batch: both
    sides to files, partitioned by batch and side, and the accepted ones on to a topic, if one
    is named. The query's progress counts ``sent`` and ``rejected``.

    A batch that is retried replaces its files. The topic gets it again: sending is at least
    once, as Kafka sinks are.
    """
    path = layout.table("published")

    def publish(batch: DataFrame, batch_id: int) -> None:
        (
            checked_records(batch)
            .withColumn(BATCH, F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH, "accepted")
            .parquet(path)
        )
        if topic:
            # From the files just written: the check runs once.
            written = read_published(batch.sparkSession, layout).where(F.col(BATCH) == batch_id)
            publish_kafka(written.where("accepted").select("key", "value"), servers, topic)

    checked = counted(check_contract(raw))
    return start(checked, layout.checkpoint("published"), each_batch=publish, **run)


def read_published(spark: SparkSession, layout: Layout) -> DataFrame:
    """Records of both sides, with the batch they came in."""
    stored = T.StructType(
        [*RECORDS.fields[:3], T.StructField(BATCH, T.LongType()), RECORDS.fields[3]]
    )
    return spark.read.schema(stored).parquet(layout.table("published"))
