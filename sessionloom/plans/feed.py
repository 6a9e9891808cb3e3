"""The driver's ``events`` table as an event feed, clean and as faulty broker records.

The feed is a fixed mapping, so that results can be checked in SQL on the same table. The faulty
feed breaks, repeats and spreads records by rules on the event id; every event takes part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.functions.scalar import computed_once, timestamp_to_epoch, utc_instant
from sessionloom.sources.broker import BROKER_SCHEMA, encode_events

# Source event type -> event type of the feed; "error" stays, as an invalid type.
TYPE_MAP = {
    "view": "page_view",
    "click": "add_to_cart",
    "signup": "search",  # every other one: remove_from_cart
    "purchase": "purchase",
    "error": "error",
}
TOPIC = "events"


def source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def clean_feed(source: DataFrame) -> DataFrame:
    """Source events as contract events, one to one, with the columns of the broker beside."""
    mapped = F.lit(None).cast("string")
    for kind, name in TYPE_MAP.items():
        mapped = F.when(F.col("event_type") == kind, name).otherwise(mapped)
    instant = utc_instant(F.col("ts"))
    user = F.concat(F.lit("user_"), F.col("user_id"))
    day = F.replace(F.to_date("ts").cast("string"), F.lit("-"), F.lit(""))
    events = source.select(
        F.col("event_id").cast("string").alias("event_id"),
        user.alias("user_id"),
        F.concat_ws("-", user, day).alias("session_id"),
        F.when((mapped == "search") & (F.col("event_id") % 2 == 0), "remove_from_cart")
        .otherwise(mapped)
        .alias("event_type"),
        F.concat(
            # Every 19th event names a product that no catalogue has.
            F.when(F.col("event_id") % 19 == 5, "gone_").otherwise("prod_"),
            F.get_json_object("props", "$.k"),
        ).alias("product_id"),
        F.col("value").alias("price"),
        timestamp_to_epoch(instant).alias("timestamp"),
        F.col("event_id").alias("seq"),
        (F.col("event_id") % 3).cast("int").alias("kafka_partition"),
        F.expr("event_id div 3").alias("kafka_offset"),
        instant.alias("kafka_timestamp"),
    )
    return computed_once(events)


def clean_records(source: DataFrame) -> DataFrame:
    """Broker records of the clean feed, and ``seq``, the event's number."""
    return encode_events(
        clean_feed(source),
        topic=F.lit(TOPIC),
        partition=F.col("kafka_partition"),
        offset=F.col("kafka_offset"),
        timestamp=F.col("kafka_timestamp"),
        timestampType=F.lit(0),
        seq=F.col("seq"),
    )


def _broken(full: Column, number: Column) -> Column:
    """JSON text of an event, broken by the first rule that matches its number."""

    def with_price(text: str) -> Column:
        return F.regexp_replace(full, '"price":[^,]*', f'"price":{text}')

    return (
        F.when(number % 53 == 0, F.left(full, F.lit(20)))
        .when(number % 47 == 1, F.regexp_replace(full, '"user_id":"[^"]*",', ""))
        .when(number % 43 == 2, with_price("null"))
        .when(number % 41 == 3, with_price('"abc"'))
        .when(number % 37 == 4, F.regexp_replace(full, r"\}$", ',"referrer":"mail"}'))
        .otherwise(full)
    )


def faulty_records(source: DataFrame) -> DataFrame:
    """Broker records of the feed: some broken, and every event whose number ends in 4 sent
    twice, the second time on partition 3. One pass over the source."""
    number = F.col("seq")
    once, twice = F.array(F.lit(False)), F.array(F.lit(False), F.lit(True))
    return (
        clean_records(source)
        .withColumn("value", _broken(F.col("value").cast("string"), number).cast("binary"))
        .withColumn("again", F.explode(F.when(number % 10 == 4, twice).otherwise(once)))
        .withColumn("partition", F.when(F.col("again"), 3).otherwise(F.col("partition")))
        .withColumn("offset", F.when(F.col("again"), F.expr("seq div 10")).otherwise(F.col("offset")))
        .select(*BROKER_SCHEMA.fieldNames())
    )


def product_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``part`` table as product catalogue."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return part.select(
        F.concat(F.lit("prod_"), F.col("p_partkey")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
    )
