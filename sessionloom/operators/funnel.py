"""View to cart to purchase conversion of sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.functions.scalar import ratio_or_zero
from sessionloom.operators.gold import COUNTED

# Funnel stages and the count that puts a session into each.
STAGES = {
    "viewed_sessions": "page_views",
    "carted_sessions": "cart_adds",
    "purchased_sessions": "purchases",
}
# Rates and the stages they divide.
RATES = {
    "view_to_cart_rate": ("carted_sessions", "viewed_sessions"),
    "cart_to_purchase_rate": ("purchased_sessions", "carted_sessions"),
    "view_to_purchase_rate": ("purchased_sessions", "viewed_sessions"),
}


def session_rollup(gold: DataFrame) -> DataFrame:
    """Counts per session over all its windows, so that a session counts once however many
    windows it spans."""
    return gold.groupBy("session_id").agg(*[F.sum(name).alias(name) for name in COUNTED])


def funnel(gold: DataFrame, version: int | None = None) -> DataFrame:
    """One row: sessions per stage and the rates between them.

    Stages are independent: a session that bought without a view still counts as purchased, so
    a rate may exceed 1. Without rows, all counts and rates are 0.
    """
    return funnel_of_sessions(session_rollup(gold), version)


def funnel_of_sessions(sessions: DataFrame, version: int | None = None) -> DataFrame:
    """Funnel over one row per session."""
    members = [F.count_if(F.col(count) > 0).alias(stage) for stage, count in STAGES.items()]
    return funnel_of_counts(sessions.agg(*members), version)


def funnel_of_counts(counts: DataFrame, version: int | None = None) -> DataFrame:
    """Funnel of the sessions per stage, one row."""
    rates = [ratio_or_zero(*stages).alias(name) for name, stages in RATES.items()]
    return counts.select(F.lit(version).cast("long").alias("gold_version"), *STAGES, *rates)
