"""Connected components of a graph held in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every end of ``links`` (a, b): the smallest id reachable.

    Each round takes the least label among neighbours, then the label of that label, so the
    distance still to go shrinks by a factor each time. Rounds are stored, which cuts the
    lineage; only the number of changed labels comes to the driver. An id with very many links
    is combined before the shuffle where it receives and split by the skew join where it sends.
    """
    both = stored(
        links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links"
    )
    labels = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
    labels = labels.select("id", F.least("id", "m").alias("component"))
    while True:
        labels = stored(labels, "labels")
        near = (
            both.join(labels, F.col("b") == F.col("id"))
            .groupBy("a")
            .agg(F.min("component").alias("near"))
        )
        step = labels.join(near, F.col("id") == F.col("a")).select(
            "id", F.col("component").alias("old"), F.least("component", "near").alias("next")
        )
        far = labels.select(F.col("id").alias("via"), F.col("component").alias("far"))
        jumped = stored(
            step.join(far, F.col("next") == F.col("via"), "left").select(
                "id", "old", F.least("next", F.coalesce("far", "next")).alias("component")
            ),
            "jumped",
        )
        labels = jumped.select("id", "component")
        if jumped.where("component <> old").isEmpty():
            return labels
