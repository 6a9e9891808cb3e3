"""Whole runs over the driver's tables: the feed lands as record files, the layers take it in.

Each run works in a fresh scratch directory and returns its layout.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.functions.scalar import utc_instant
from sessionloom.operators.bronze import decode_records
from sessionloom.operators.silver import to_silver
from sessionloom.plans.feed import clean_feed, faulty_records, source_events
from sessionloom.session import scratch_dir
from sessionloom.sources.broker import stream_record_files
from sessionloom.sources.batches import BatchTable
from sessionloom.sources.tables import BRONZE_SCHEMA, Layout, read_layer, silver_schema
from sessionloom.streaming.layers import ONCE, gold_table, start_bronze, start_gold, start_silver
from sessionloom.streaming.sessions import MergedSessionState, SessionState, start_session_state


def bronze_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_records(faulty_records(source_events(spark, sf_dir)))


def clean_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(clean_feed(source_events(spark, sf_dir)))


class Run:
    """Layers fed from record files, in one or more arrivals."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.layout = Layout(scratch_dir(spark, name))
        self.records = f"{self.layout.base}/records"
        self.run: Mapping = {
            "trigger": ONCE,
            "state_partitions": spark.sparkContext.defaultParallelism,
        }

    def land(self, records: DataFrame) -> Run:
        records.write.mode("append").parquet(self.records)
        return self

    def into_bronze(self, **options) -> Run:
        records = stream_record_files(self.spark, self.records)
        start_bronze(records, self.layout, **self.run, **options).awaitTermination()
        return self

    def into_silver(self, **options) -> Run:
        start_silver(self.spark, self.layout, **self.run, **options).awaitTermination()
        return self

    def into_gold(self) -> Run:
        start_gold(self.spark, self.layout, **self.run).awaitTermination()
        return self

    def into_sessions(self, **options) -> SessionState | MergedSessionState:
        state, query = start_session_state(self.spark, self.layout, **self.run, **options)
        query.awaitTermination()
        return state

    def bronze(self) -> DataFrame:
        return read_layer(self.spark, self.layout, "bronze", BRONZE_SCHEMA)

    def silver(
        self,
        since: datetime | None = None,
        until: datetime | None = None,
        extra: list[T.StructField] | None = None,
    ) -> DataFrame:
        return read_layer(self.spark, self.layout, "silver", silver_schema(extra), since, until)

    def gold(self) -> BatchTable:
        return gold_table(self.spark, self.layout)


def first_half(source: DataFrame, column: Column) -> Column:
    """True for instants in the first half of the time the source covers, and for none: every
    row is in one half."""
    span = F.unix_micros(utc_instant(F.col("ts")))
    ends = source.agg(F.min(span).alias("first"), F.max(span).alias("last")).first()
    middle = ((ends["first"] or 0) + (ends["last"] or 0)) // 2
    return F.coalesce(F.unix_micros(column) <= middle, F.lit(True))


def parts_of(source: DataFrame, column: Column, parts: int) -> list[Column]:
    """Conditions that split instants into equal parts of the time the source covers; what is
    none, is in the first."""
    span = F.unix_micros(utc_instant(F.col("ts")))
    ends = source.agg(F.min(span).alias("first"), F.max(span).alias("last")).first()
    first, length = ends["first"] or 0, (ends["last"] or 0) - (ends["first"] or 0) + 1
    part = F.coalesce(F.floor((F.unix_micros(column) - first) * parts / length), F.lit(0))
    return [part == i for i in range(parts)]


def streamed(spark: SparkSession, sf_dir: str, name: str) -> Run:
    """The faulty feed, arrived at once."""
    return Run(spark, name).land(faulty_records(source_events(spark, sf_dir)))


def two_halves(spark: SparkSession, sf_dir: str, name: str) -> tuple[Run, DataFrame]:
    """The faulty feed with its first half landed, and the records still to come."""
    source = source_events(spark, sf_dir)
    # A record's time is its event's: events are told apart before records are made of them.
    early = first_half(source, utc_instant(F.col("ts")))
    first, rest = (faulty_records(source.where(half)) for half in (early, ~early))
    return Run(spark, name).land(first), rest


def arriving(spark: SparkSession, sf_dir: str, name: str, parts: int) -> tuple[Run, list[DataFrame]]:
    """A run without records, and the faulty feed in arrivals that follow each other in time."""
    source = source_events(spark, sf_dir)
    conditions = parts_of(source, utc_instant(F.col("ts")), parts)
    return Run(spark, name), [faulty_records(source.where(condition)) for condition in conditions]
