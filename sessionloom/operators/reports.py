"""Reports over the silver and gold layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.functions.scalar import micros


def hourly_revenue(gold: DataFrame) -> DataFrame:
    """Revenue and purchases per hour, by window start."""
    return gold.groupBy(F.date_trunc("hour", "window_start").alias("hour")).agg(
        F.sum("revenue").alias("revenue"), F.sum("purchases").alias("purchases")
    )


def purchase_totals(silver: DataFrame) -> DataFrame:
    """Revenue and purchases per product. Reads silver: gold has no products."""
    return (
        silver.where(F.col("event_type") == "purchase")
        .groupBy("product_id")
        .agg(F.sum("price").alias("revenue"), F.count("*").alias("purchases"))
    )


def top_of(totals: DataFrame, n: int = 10) -> DataFrame:
    return totals.orderBy(F.desc("revenue"), "product_id").limit(n)


def top_products(silver: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` products with the most purchase revenue; ties go to the lower product id."""
    return top_of(purchase_totals(silver), n)


def session_spans(silver: DataFrame) -> DataFrame:
    """First and last event of each session, and how many."""
    return silver.groupBy("session_id").agg(
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
        F.count("*").alias("events"),
    )


def session_durations(spans: DataFrame) -> DataFrame:
    """Session spans with the whole seconds between first and last event."""
    elapsed = F.timestamp_diff("SECOND", F.col("first_event"), F.col("last_event"))
    return spans.withColumn("duration_s", elapsed)


def duration_bucket(bucket: str = "5 minutes") -> Column:
    """Lower bound, in seconds, of the bucket a session's duration is in."""
    width = micros(bucket) // 1_000_000
    seconds = F.timestamp_diff("SECOND", F.col("first_event"), F.col("last_event"))
    return (seconds - seconds % width).alias("bucket_start_s")


def duration_buckets(spans: DataFrame, bucket: str = "5 minutes") -> DataFrame:
    """Sessions per duration bucket."""
    return spans.groupBy(duration_bucket(bucket)).agg(F.count("*").alias("sessions"))


def duration_histogram(silver: DataFrame, bucket: str = "5 minutes") -> DataFrame:
    return duration_buckets(session_spans(silver), bucket)


# Durations per coarse bucket of the first pass over them.
COARSE = 1 << 16


def duration_quantiles(
    silver: DataFrame, at: tuple[float, ...] = (0.5, 0.9, 0.99)
) -> DataFrame:
    """Exact interpolated quantiles of the session durations, one row."""
    return exact_quantiles(session_durations(session_spans(silver)), at)


def exact_quantiles(
    durations: DataFrame, at: tuple[float, ...] = (0.5, 0.9, 0.99)
) -> DataFrame:
    """Exact interpolated quantiles of ``duration_s``, one row.

    Sessions are counted per second. A first pass sums them by coarse bucket and finds, per
    quantile, the buckets that hold the two ranks it lies between; a second reads the seconds
    of those buckets alone. No task holds more than the coarse buckets, or the distinct seconds
    of a few of them.
    """
    seconds = (
        durations.where("duration_s is not null")
        .groupBy("duration_s")
        .agg(F.count("*").alias("sessions"))
        .withColumn("coarse", F.expr(f"duration_s div {COARSE}"))
    )
    coarse = seconds.groupBy("coarse").agg(F.sum("sessions").alias("in_coarse"))
    before = Window.orderBy("coarse").rowsBetween(Window.unboundedPreceding, -1)
    coarse = coarse.select(
        "coarse",
        "in_coarse",
        F.coalesce(F.sum("in_coarse").over(before), F.lit(0)).alias("below"),
        F.sum("in_coarse").over(Window.partitionBy()).alias("total"),
    )
    ranks = [F.lit(q) * (F.col("total") - 1) for q in at]
    wanted = F.array_distinct(
        F.array(
            *[
                F.struct(F.lit(i).alias("i"), end(rank).cast("long").alias("rank"))
                for i, rank in enumerate(ranks)
                for end in (F.floor, F.ceil)
            ]
        )
    )
    places = coarse.select("coarse", "below", "in_coarse", F.explode(wanted).alias("want")).where(
        (F.col("want.rank") >= F.col("below"))
        & (F.col("want.rank") < F.col("below") + F.col("in_coarse"))
    )
    # One row per quantile end and second of its bucket.
    inside = Window.partitionBy("want").orderBy("duration_s")
    found = (
        seconds.join(F.broadcast(places), "coarse")
        .withColumn("upto", F.col("below") + F.sum("sessions").over(inside))
        .where("upto > want.rank")
        .groupBy("want")
        .agg(F.min("duration_s").alias("value"))
    )
    totals = seconds.agg(
        F.sum("sessions").alias("sessions"), F.max("duration_s").cast("double").alias("longest")
    )
    ends = found.agg(F.sort_array(F.collect_list(F.struct("want.i", "want.rank", "value"))).alias("ends"))
    row = totals.select(
        "sessions", "longest", ends.scalar().alias("ends")
    )
    quantiles = [
        _between(i, q).alias(f"p{q * 100:g}") for i, q in enumerate(at)
    ]
    return row.select("sessions", "longest", *quantiles)


def _between(number: int, q: float) -> Column:
    """Linear interpolation between the values at the ranks below and above."""
    exact = F.lit(q) * (F.col("sessions") - 1)
    values = F.filter("ends", lambda end: end["i"] == number)["value"]
    low, high = F.array_min(values), F.array_max(values)
    return low + (high - low) * (exact - F.floor(exact))
