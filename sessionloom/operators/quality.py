"""Audits of the layers against each other. Each returns a DataFrame; none collects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.functions.contract import EVENT_FIELDS, FIELDS, all_present, known_type
from sessionloom.functions.scalar import epoch_to_timestamp
from sessionloom.operators.gold import COUNTED, METRICS, metric_aggregates


def offset_audit(bronze: DataFrame) -> DataFrame:
    """Per broker partition: records, distinct offsets, range, and what is missing or repeated.
    The distinct count is spread over (partition, offset), so a single huge partition does not
    land in one task. Compacted or transactional topics have gaps by design.
    """
    return (
        bronze.groupBy("kafka_partition")
        .agg(
            F.count("*").alias("records"),
            F.count_distinct("kafka_offset").alias("offsets"),
            F.min("kafka_offset").alias("first_offset"),
            F.max("kafka_offset").alias("last_offset"),
        )
        .withColumn("missing", F.expr("last_offset - first_offset + 1 - offsets"))
        .withColumn("repeated", F.expr("records - offsets"))
    )


# Offsets looked at together for gaps.
SPAN = 1 << 16


def offset_gaps(bronze: DataFrame, span: int = SPAN) -> DataFrame:
    """Every missing range of offsets and every repeated offset: kind, kafka_partition,
    first_offset, last_offset, records (how often a repeated offset was received, 0 for a gap).

    Offsets are taken in stretches of ``span``: gaps inside one are found there, so a huge
    partition spreads over as many tasks as it has stretches, and gaps between stretches from the
    first and last offset of each, one row per stretch.
    """
    offsets = (
        bronze.groupBy("kafka_partition", "kafka_offset")
        .agg(F.count("*").alias("records"))
        .withColumn("_stretch", F.expr(f"floor(kafka_offset / {span})"))
    )
    inside = Window.partitionBy("kafka_partition", "_stretch").orderBy("kafka_offset")
    followed = offsets.withColumn("_next", F.lead("kafka_offset").over(inside))
    repeated = followed.where("records > 1").select(
        F.lit("repeated").alias("kind"),
        "kafka_partition",
        F.col("kafka_offset").alias("first_offset"),
        F.col("kafka_offset").alias("last_offset"),
        "records",
    )
    ends = followed.groupBy("kafka_partition", "_stretch").agg(
        F.min("kafka_offset").alias("_first"), F.max("kafka_offset").alias("kafka_offset")
    )
    stretches = Window.partitionBy("kafka_partition").orderBy("_stretch")
    between = ends.withColumn("_next", F.lead("_first").over(stretches))
    pairs = ["kafka_partition", "kafka_offset", "_next"]
    missing = (
        followed.select(*pairs)
        .unionByName(between.select(*pairs))
        .where("_next > kafka_offset + 1")
        .select(
            F.lit("missing").alias("kind"),
            "kafka_partition",
            (F.col("kafka_offset") + 1).alias("first_offset"),
            (F.col("_next") - 1).alias("last_offset"),
            F.lit(0).cast("long").alias("records"),
        )
    )
    return missing.unionByName(repeated)


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows the two tables do not hold equally often, with ``surplus`` = times in left minus
    times in right. Both directions of EXCEPT ALL in one aggregate, combined before its shuffle.
    """
    columns = left.columns
    marked = left.select(*columns, F.lit(1).alias("_side")).unionByName(
        right.select(*columns, F.lit(-1).alias("_side"))
    )
    return (
        marked.groupBy(*columns)
        .agg(F.sum("_side").alias("surplus"))
        .where(F.col("surplus") != 0)
    )


# Buckets of a digest tree.
BUCKETS = 4096


def _hashed(table: DataFrame, columns: list[str], buckets: int) -> DataFrame:
    """128 bits of every row's content, and its bucket: long texts stay where they are. The hash
    passes over nulls, so which columns are null is hashed too."""
    content = [*map(F.col, columns), *[F.col(c).isNull() for c in columns]]
    hashed = table.withColumns(
        {"_a": F.xxhash64(*content), "_b": F.xxhash64(F.lit(1), *content)}
    )
    return hashed.withColumn("_bucket", F.pmod("_a", F.lit(buckets)))


def table_digests(table: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(_bucket, _rows, _digest): what the rows of a hash bucket add up to, whatever their order
    and however often each is there. Combined before its shuffle, which moves a row per task and
    bucket. Halves of the hashes are summed, so that 64 bits hold 2 ** 31 rows."""
    hashed = _hashed(table, table.columns, buckets)
    halves = [h for c in ("_a", "_b") for h in (F.shiftright(c, 32), F.col(c).bitwiseAND(0xFFFFFFFF))]
    sums = [F.sum(half).alias(f"_{i}") for i, half in enumerate(halves)]
    digests = hashed.groupBy("_bucket").agg(F.count("*").alias("_rows"), *sums)
    return digests.select("_bucket", "_rows", F.array(*[f"_{i}" for i in range(len(sums))]).alias("_digest"))


def _compared(left: DataFrame, right: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Digests of both tables side by side, and the rows of the buckets in which they differ, with
    ``_side`` 1 or -1. Of equal tables no row goes any further."""
    columns = left.columns
    digests = [table_digests(t.select(columns), buckets) for t in (left, right)]
    both = digests[0].join(
        digests[1].withColumnsRenamed({"_rows": "_rows_right", "_digest": "_digest_right"}),
        "_bucket",
        "full",
    )
    differ = both.where("not _digest <=> _digest_right").select("_bucket")
    marked = left.select(*columns, F.lit(1).alias("_side")).unionByName(
        right.select(*columns, F.lit(-1).alias("_side"))
    )
    # At most a row per bucket is sent to all tasks.
    opened = _hashed(marked, columns, buckets).join(F.broadcast(differ), "_bucket", "left_semi")
    return both, opened


def compare_tables(left: DataFrame, right: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row: row count of each table and how many rows only one of them has. Digests are
    compared first; only buckets that differ are opened."""
    both, opened = _compared(left, right, buckets)
    per_row = opened.groupBy("_a", "_b").agg(F.sum("_side").alias("_surplus"))
    zero = F.lit(0).cast("long")
    only = per_row.agg(
        F.coalesce(F.sum(F.greatest("_surplus", zero)), zero).alias("only_left"),
        F.coalesce(F.sum(F.greatest(-F.col("_surplus"), zero)), zero).alias("only_right"),
    )
    sizes = both.agg(
        F.coalesce(F.sum("_rows"), zero).alias("rows_left"),
        F.coalesce(F.sum("_rows_right"), zero).alias("rows_right"),
    )
    return sizes.select(
        "rows_left",
        "rows_right",
        only.select("only_left").scalar().alias("only_left"),
        only.select("only_right").scalar().alias("only_right"),
    )


def changed_rows(left: DataFrame, right: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``row_differences`` by way of digests: only buckets that differ are opened."""
    _, opened = _compared(left, right, buckets)
    per_row = opened.groupBy(*left.columns).agg(F.sum("_side").alias("surplus"))
    return per_row.where(F.col("surplus") != 0)


def missing_values(df: DataFrame) -> DataFrame:
    """One row: the rows of a layer and, per event field, those without a value."""
    return df.agg(
        F.count("*").alias("rows"),
        *[
            F.count_if(_no_value(name)).alias(f"no_{name}")
            for name in EVENT_FIELDS
        ],
    )


def silver_audit(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Missing values and row counts of both layers, one row each."""
    return (
        missing_values(bronze)
        .withColumn("layer", F.lit("bronze"))
        .unionByName(missing_values(silver).withColumn("layer", F.lit("silver")))
        .select("layer", "rows", *[f"no_{name}" for name in FIELDS])
    )


def _no_value(name: str) -> Column:
    return ~all_present({name: EVENT_FIELDS[name]})


def session_totals(silver: DataFrame) -> DataFrame:
    """Metrics per session straight from its events, without windows."""
    return silver.groupBy("session_id").agg(*metric_aggregates())


def gold_reconcile(silver: DataFrame, gold: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Sessions whose gold totals differ from their events, with both totals.

    Each side is aggregated to one row per session first, so the join sees no hot key. Revenue,
    a sum of doubles, may differ by ``tolerance`` relative to its size.
    """
    per_session = gold.groupBy("session_id").agg(*[F.sum(m).alias(m) for m in METRICS])
    source = session_totals(silver)
    both = source.select("session_id", *[F.col(m).alias(f"silver_{m}") for m in METRICS]).join(
        per_session.select("session_id", *[F.col(m).alias(f"gold_{m}") for m in METRICS]),
        "session_id",
        "full",
    )
    differs = [~F.col(f"silver_{m}").eqNullSafe(F.col(f"gold_{m}")) for m in COUNTED]
    paid, booked = F.col("silver_revenue"), F.col("gold_revenue")
    close = F.abs(paid - booked) <= tolerance * F.greatest(F.abs(paid), F.lit(1.0))
    differs.append(~F.coalesce(close, F.lit(False)))
    return both.where(reduce(Column.__or__, differs))


def drop_reason() -> Column:
    """Why silver refuses a bronze row on its own account; null where it does not."""
    return F.when(~all_present(), "missing_field").when(~known_type(), "unknown_type")


def layer_counts(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """End-to-end account as (step, rows): where the bronze rows went, and how many of the
    events gold should count it has not, because their windows are still open."""
    reasons = (
        bronze.withColumn("_reason", drop_reason())
        .groupBy("_reason")
        .agg(F.count("*").alias("rows"), F.count_distinct("event_id").alias("ids"))
        .agg(
            F.sum("rows").alias("bronze"),
            *[
                F.sum(F.when(F.col("_reason") == reason, F.col("rows")).otherwise(0)).alias(reason)
                for reason in ("missing_field", "unknown_type")
            ],
            F.sum(F.when(F.col("_reason").isNull(), F.col("rows") - F.col("ids"))).alias("repeated"),
            F.sum(F.when(F.col("_reason").isNull(), F.col("ids"))).alias("distinct_valid"),
        )
    )
    kept = silver.agg(
        F.count("*").alias("silver"),
        F.count_if(F.col("event_type").isin(*COUNTED.values())).alias("countable"),
    )
    counted = gold.agg(*[F.sum(name).alias(name) for name in COUNTED])
    steps = {
        "1_bronze": "bronze",
        "2_missing_field": "missing_field",
        "3_unknown_type": "unknown_type",
        "4_repeated": "repeated",
        "5_late": "distinct_valid - silver",
        "6_silver": "silver",
        "7_counted_in_gold": " + ".join(COUNTED),
        "8_in_open_windows": f"countable - ({' + '.join(COUNTED)})",
    }
    # One row per layer, folded into one: no join needed.
    names = [*reasons.columns, *kept.columns, *counted.columns]
    account = (
        reasons.unionByName(kept, allowMissingColumns=True)
        .unionByName(counted, allowMissingColumns=True)
        .agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    )
    pairs = ", ".join(f"'{step}', cast({value} as bigint)" for step, value in steps.items())
    return account.select(F.expr(f"stack({len(steps)}, {pairs}) as (step, rows)"))


def lost_events(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Events valid in bronze that silver does not have: they came behind its watermark.

    With each: the copies received, its time, and how far behind the newest event it lies.
    Bronze is reduced to one row per id before the join, so an id with very many copies does
    not travel as rows.
    """
    valid = (
        bronze.where(all_present() & known_type())
        .withColumn("event_time", epoch_to_timestamp("timestamp"))
        .groupBy("event_id")
        .agg(F.min("event_time").alias("event_time"), F.count("*").alias("copies"))
    )
    lost = valid.join(silver.select("event_id"), "event_id", "left_anti")
    newest = silver.agg(F.max("event_time"))
    behind = F.timestamp_diff("SECOND", F.col("event_time"), newest.scalar())
    return lost.select("event_id", "event_time", "copies", behind.alias("behind_s"))
