"""Every query by name, (spark, sf_dir) -> DataFrame, and the DuckDB SQL it must equal.

Queries named ``*_stream`` run streaming queries to their end and return the resulting table.
"""

from __future__ import annotations

import io
from collections.abc import Callable
from contextlib import redirect_stdout
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.functions.contract import (
    FIELDS,
    check_contract,
    event_schema,
    violation_rows,
)
from sessionloom.functions.scalar import utc_wall_clock
from sessionloom.operators import funnel as funnels
from sessionloom.operators import quality, reports
from sessionloom.operators.enrich import enrich, enrich_batches
from sessionloom.operators.gold import activity_windows, session_metrics
from sessionloom.operators.silver import clean, to_silver
from sessionloom.plans import sql
from sessionloom.plans.feed import clean_records, faulty_records, product_catalog, source_events
from sessionloom.plans.runs import (
    Run,
    arriving,
    bronze_batch,
    clean_silver,
    first_half,
    streamed,
    two_halves,
)
from sessionloom.session import scratch_dir
from sessionloom.sources.batches import DATE, BatchTable
from sessionloom.sources.broker import BROKER_SCHEMA, stream_record_files
from sessionloom.sources.files import children
from sessionloom.sources.tables import (
    GOLD_SCHEMA,
    SILVER_SCHEMA,
    Layout,
    compact_silver,
    dated,
    publish as publish_view,
    read_layer,
    read_table,
    registered,
    replace_table,
)
from sessionloom.streaming import progress, refresh
from sessionloom.streaming import state as state_tables
from sessionloom.streaming.layers import start, start_bronze, stream_layer
from sessionloom.streaming.progress import ProgressLog
from sessionloom.streaming.publish import (
    publish_checked,
    read_published,
    split_counts,
    start_publish,
)
from sessionloom.streaming.refresh import start_refresh
from sessionloom.streaming.state import state_audit

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


def presented(df: DataFrame) -> DataFrame:
    """Instants as UTC wall clock, money to the cent: what the SQL side can be compared with."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = utc_wall_clock(column)
        elif field.name.endswith("revenue"):
            column = F.round(column, 2)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a table of their own, for a layer that is read more than once."""
    path = f"{scratch_dir(df.sparkSession, name)}/table"
    replace_table(df, path)
    return read_table(df.sparkSession, path, df.schema)


_silvers: dict[tuple, str] = {}


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of the clean feed as a stored, dated table, made once per application and state of
    the events' files: what a report reads."""
    parts = ("file_path", "file_size", "file_modification_time")
    files = source_events(spark, sf_dir).select(*[f"_metadata.{part}" for part in parts])
    found = sorted(map(tuple, files.distinct().collect()))
    key = (spark.conf.get("spark.app.id"), sf_dir, *found)
    if key not in _silvers:
        layout = Layout(scratch_dir(spark, "silver"))
        rows = dated(clean_silver(spark, sf_dir), "event_time")
        rows.write.partitionBy(DATE).parquet(layout.table("silver"))
        _silvers[key] = layout.base
    return read_layer(spark, Layout(_silvers[key]), "silver", SILVER_SCHEMA)


# -- The feed in SQL -----------------------------------------------------------------------

_FEED = """
feed AS (
    SELECT CAST(event_id AS VARCHAR) AS event_id,
           'user_' || user_id AS user_id,
           'user_' || user_id || '-' || strftime(ts, '%Y%m%d') AS session_id,
           CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
                WHEN 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'remove_from_cart' ELSE 'search' END
                WHEN 'purchase' THEN 'purchase'
                WHEN 'error' THEN 'error' END AS event_type,
           CASE WHEN event_id % 19 = 5 THEN 'gone_' ELSE 'prod_' END
               || regexp_extract(props, '[0-9]+') AS product_id,
           value AS price,
           epoch_us(ts) / 1e6 AS "timestamp",
           ts AS event_time,
           event_id AS n,
           CASE WHEN event_id % 53 = 0 THEN 1 WHEN event_id % 47 = 1 THEN 2
                WHEN event_id % 43 = 2 THEN 3 WHEN event_id % 41 = 3 THEN 4 ELSE 0 END AS fault,
           event_id % 53 <> 0 AND event_id % 47 <> 1 AND event_id % 43 <> 2
               AND event_id % 41 <> 3 AND event_id % 37 = 4 AS extra,
           epoch_us(ts) <= (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 FROM events)
               AS early
    FROM events
), sent AS (
    SELECT *, CAST(n % 3 AS INTEGER) AS p, n // 3 AS o FROM feed
    UNION ALL
    SELECT *, 3 AS p, n // 10 AS o FROM feed WHERE n % 10 = 4
), decoded AS (
    SELECT p AS kafka_partition, o AS kafka_offset, event_time AS kafka_timestamp,
           CASE WHEN fault <> 1 THEN event_id END AS event_id,
           CASE WHEN fault NOT IN (1, 2) THEN user_id END AS user_id,
           CASE WHEN fault <> 1 THEN session_id END AS session_id,
           CASE WHEN fault <> 1 THEN event_type END AS event_type,
           CASE WHEN fault <> 1 THEN product_id END AS product_id,
           CASE WHEN fault NOT IN (1, 3, 4) THEN price END AS price,
           CASE WHEN fault <> 1 THEN "timestamp" END AS "timestamp"
    FROM sent
), faulty_silver AS (
    SELECT * FROM feed WHERE fault = 0 AND event_type <> 'error'
), clean_silver AS (
    SELECT * FROM feed WHERE event_type <> 'error'
)"""

_METRICS = """
           CAST(count(*) FILTER (WHERE event_type = 'page_view') AS BIGINT) AS page_views,
           CAST(count(*) FILTER (WHERE event_type = 'add_to_cart') AS BIGINT) AS cart_adds,
           CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS purchases,
           sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0.0 END) AS revenue"""


def _gold(silver: str, name: str = "gold") -> str:
    return f"""{name} AS (
    SELECT session_id,
           time_bucket(INTERVAL '5 minutes', event_time) AS window_start,
           time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes' AS window_end,
           {_METRICS}
    FROM {silver}
    GROUP BY 1, 2, 3
)"""


_CLEAN_GOLD = f"WITH {_FEED}, {_gold('clean_silver')}"
_FAULTY_GOLD = f"WITH {_FEED}, {_gold('faulty_silver')}"
# Windows a stream has emitted once it has seen all of the feed, or its first half.
_CLOSED = "window_end <= (SELECT max(event_time) FROM faulty_silver) - INTERVAL '2 minutes'"
_CLOSED_EARLY = (
    "window_end <= (SELECT max(event_time) FROM faulty_silver WHERE early) - INTERVAL '2 minutes'"
)
_GOLD_COLUMNS = (
    "session_id, window_start, window_end, page_views, cart_adds, purchases, "
    "round(revenue, 2) AS revenue"
)
_EVENT_COLUMNS = ", ".join(f'"{f}"' for f in FIELDS)


def _funnel_sql(gold: str) -> str:
    def rate(part: str, whole: str) -> str:
        return f"CASE WHEN {whole} = 0 THEN 0.0 ELSE CAST({part} AS DOUBLE) / {whole} END"

    return f""", sessions AS (
    SELECT session_id, sum(page_views) AS v, sum(cart_adds) AS c, sum(purchases) AS b
    FROM {gold} GROUP BY session_id
), stages AS (
    SELECT CAST(count(*) FILTER (WHERE v > 0) AS BIGINT) AS viewed_sessions,
           CAST(count(*) FILTER (WHERE c > 0) AS BIGINT) AS carted_sessions,
           CAST(count(*) FILTER (WHERE b > 0) AS BIGINT) AS purchased_sessions
    FROM sessions
)
SELECT *, {rate("carted_sessions", "viewed_sessions")} AS view_to_cart_rate,
       {rate("purchased_sessions", "carted_sessions")} AS cart_to_purchase_rate,
       {rate("purchased_sessions", "viewed_sessions")} AS view_to_purchase_rate
FROM stages"""


# -- Raw layer -----------------------------------------------------------------------------

_DECODED = f"WITH {_FEED} SELECT * FROM decoded"


@query(_DECODED)
def bronze_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(bronze_batch(spark, sf_dir).drop("raw_value"))


@query(f"WITH {_FEED} SELECT {_EVENT_COLUMNS} FROM feed")
def strict_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sound events through the contract's schema with all fields required."""
    body = F.col("value").cast("string")
    records = clean_records(source_events(spark, sf_dir))
    parsed = records.select(F.inline(F.array(F.from_json(body, event_schema(strict=True)))))
    return parsed.select(*FIELDS)


@query(_DECODED)
def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = streamed(spark, sf_dir, "bronze_stream").into_bronze()
    return presented(run.bronze().drop("raw_value"))


@query(_DECODED)
def bronze_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stopped after half of the records and started again on the same checkpoint."""
    run, rest = two_halves(spark, sf_dir, "bronze_restart")
    run.into_bronze().land(rest).into_bronze()
    return presented(run.bronze().drop("raw_value"))


@query(_DECODED)
def backfill_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older records land after newer ones were taken in, as a back-fill does."""
    source = source_events(spark, sf_dir)
    records = faulty_records(source)
    early = first_half(source, F.col("timestamp"))
    run = Run(spark, "backfill_stream").land(records.where(~early)).into_bronze()
    return presented(run.land(records.where(early)).into_bronze().bronze().drop("raw_value"))


@query(_DECODED)
def bronze_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query that runs until it is stopped, with records landing while it runs."""
    run, rest = two_halves(spark, sf_dir, "bronze_live")
    records = stream_record_files(spark, run.records)
    live = start_bronze(records, run.layout, trigger={"processingTime": "200 milliseconds"})
    try:
        live.processAllAvailable()
        run.land(rest)
        live.processAllAvailable()
    finally:
        live.stop()
    return presented(run.bronze().drop("raw_value"))


@query(
    f"""WITH {_FEED}
    SELECT count(*) AS rows_left, count(*) AS rows_right,
           CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right
    FROM sent"""
)
def replay_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze against its rebuild from the earliest record with a fresh checkpoint."""
    run = streamed(spark, sf_dir, "replay_diff").into_bronze()
    again = Run(spark, "replay_diff")
    again.records = run.records
    again.into_bronze()
    return quality.compare_tables(run.bronze(), again.bronze())


@query(
    f"""WITH {_FEED}
    SELECT kafka_partition, count(*) AS records, count(DISTINCT kafka_offset) AS offsets,
           min(kafka_offset) AS first_offset, max(kafka_offset) AS last_offset,
           max(kafka_offset) - min(kafka_offset) + 1 - count(DISTINCT kafka_offset) AS missing,
           count(*) - count(DISTINCT kafka_offset) AS repeated
    FROM decoded GROUP BY kafka_partition"""
)
def offset_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of a bronze table that was written with a restart in between."""
    run, rest = two_halves(spark, sf_dir, "offset_audit")
    return quality.offset_audit(run.into_bronze().land(rest).into_bronze().bronze())


# What does not arrive, and what arrives twice.
_LOST = "({o} % 500 BETWEEN 100 AND 102 OR {o} % 777 = 5)"
_TWICE = "{o} % 321 = 7"


@query(
    f"""WITH {_FEED}, got AS (
        SELECT p, o FROM sent WHERE NOT {_LOST.format(o='o')}
        UNION ALL SELECT p, o FROM sent WHERE NOT {_LOST.format(o='o')} AND {_TWICE.format(o='o')}
    ), places AS (SELECT p, o, count(*) AS n FROM got GROUP BY p, o), followed AS (
        SELECT *, lead(o) OVER (PARTITION BY p ORDER BY o) AS next FROM places
    )
    SELECT 'missing' AS kind, p AS kafka_partition, o + 1 AS first_offset, next - 1 AS last_offset,
           CAST(0 AS BIGINT) AS records FROM followed WHERE next > o + 1
    UNION ALL SELECT 'repeated', p, o, o, n FROM places WHERE n > 1"""
)
def offset_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where records are missing in bronze, and which came twice."""
    records = faulty_records(source_events(spark, sf_dir))
    records = records.where("not " + _LOST.format(o="`offset`"))
    records = records.unionByName(records.where(_TWICE.format(o="`offset`")))
    run = Run(spark, "offset_gaps").land(records).into_bronze()
    return quality.offset_gaps(run.bronze(), span=64)


@query(
    f"""WITH {_FEED}
    SELECT {_EVENT_COLUMNS}, CASE WHEN early THEN NULL ELSE 'web' END AS channel FROM feed"""
)
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract gains a field mid-stream. Records of the second half carry it; the bronze
    query is restarted on its checkpoint with the longer schema, and older rows read as null."""
    source = source_events(spark, sf_dir)
    early = first_half(source, F.col("timestamp"))
    records = clean_records(source)
    body = F.regexp_replace(F.col("value").cast("string"), r"\}$", ',"channel":"web"}')
    grown_records = records.withColumn("value", body.cast("binary"))
    names = BROKER_SCHEMA.fieldNames()

    run = Run(spark, "schema_evolution")
    run.land(records.where(early).select(*names)).into_bronze()
    grown = event_schema(strict=False, extra=[T.StructField("channel", T.StringType())])
    run.land(grown_records.where(~early).select(*names)).into_bronze(schema=grown)
    return read_layer(spark, run.layout, "bronze", grown)


_CHANNEL = [T.StructField("channel", T.StringType())]


@query(
    f"""WITH {_FEED}
    SELECT {_EVENT_COLUMNS}, CASE WHEN early THEN NULL ELSE 'web' END AS channel, event_time
    FROM faulty_silver"""
)
def schema_evolution_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new field reaches silver on the checkpoints both queries had before. The second arrival
    also has all records of the first once more, now with the field: the dedupe still knows their
    ids or they are late, so none of them comes in."""
    source = source_events(spark, sf_dir)
    early = first_half(source, F.col("timestamp"))
    records = faulty_records(source)
    body = F.regexp_replace(F.col("value").cast("string"), r"\}$", ',"channel":"web"}')
    grown = records.withColumn("value", body.cast("binary"))
    run = Run(spark, "schema_evolution_silver").land(records.where(early))
    run.into_bronze().into_silver()
    run.land(grown).into_bronze(extra=_CHANNEL).into_silver(extra=_CHANNEL)
    return presented(run.silver(extra=_CHANNEL))


# -- Contract ------------------------------------------------------------------------------

_VALID_NAMES = "[''add_to_cart'', ''page_view'', ''purchase'', ''remove_from_cart'', ''search'']"
_VIOLATIONS = f"""
violations AS (
    SELECT p, o, 'unparseable JSON' AS violation FROM sent WHERE fault = 1
    UNION ALL
    SELECT p, o, 'missing required field ''user_id''' FROM sent WHERE fault = 2
    UNION ALL
    SELECT p, o, 'field ''price'' has type NoneType, expected one of [''int'', ''float'']'
    FROM sent WHERE fault = 3
    UNION ALL
    SELECT p, o, 'field ''price'' has type str, expected one of [''int'', ''float'']'
    FROM sent WHERE fault = 4
    UNION ALL
    SELECT p, o,
           'field ''event_type'' has invalid value ''error'', expected one of {_VALID_NAMES}'
    FROM sent WHERE fault <> 1 AND event_type = 'error'
    UNION ALL
    SELECT p, o, 'unexpected extra field(s): [''referrer'']' FROM sent WHERE extra
)"""
_SPLIT = """
    SELECT CAST(count(*) FILTER (WHERE fault = 0 AND NOT extra AND event_type <> 'error') AS BIGINT)
               AS sent,
           CAST(count(*) FILTER (WHERE fault <> 0 OR extra OR event_type = 'error') AS BIGINT)
               AS rejected
    FROM sent"""


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = faulty_records(source_events(spark, sf_dir))
    return records.select("partition", "offset", F.col("value").cast("string").alias("raw_value"))


@query(f"WITH {_FEED}, {_VIOLATIONS} SELECT p AS partition, o AS \"offset\", violation FROM violations")
def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violation_rows(check_contract(_raw(spark, sf_dir)), "partition", "offset")


@query(f"WITH {_FEED} {_SPLIT}")
def contract_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_counts(check_contract(_raw(spark, sf_dir)))


_PUBLISHED = f"""WITH {_FEED}
    SELECT fault = 0 AND NOT extra AND event_type <> 'error' AS accepted,
           CASE WHEN fault <> 1 THEN session_id END AS session_id, count(*) AS records
    FROM sent GROUP BY 1, 2"""


@query(_PUBLISHED)
def publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checked and published in one pass; read back as records per key and side."""
    path = f"{scratch_dir(spark, 'publish')}/records"
    publish_checked(_raw(spark, sf_dir), path)
    return _per_side(spark.read.schema("key binary, value binary, accepted boolean").parquet(path))


def _per_side(written: DataFrame) -> DataFrame:
    return written.groupBy("accepted", F.col("key").cast("string").alias("session_id")).agg(
        F.count("*").alias("records")
    )


@query(_PUBLISHED)
def publish_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stream, stopped after half of the records and started again."""
    run, rest = two_halves(spark, sf_dir, "publish_stream")
    for arrival in (None, rest):
        if arrival is not None:
            run.land(arrival)
        raw = stream_record_files(spark, run.records).select(
            F.col("value").cast("string").alias("raw_value")
        )
        start_publish(raw, run.layout, **run.run).awaitTermination()
    return _per_side(read_published(spark, run.layout))


# -- Clean layer ---------------------------------------------------------------------------

_SILVER = f"WITH {_FEED} SELECT {_EVENT_COLUMNS}, event_time FROM faulty_silver"


@query(
    f"""WITH {_FEED} SELECT {_EVENT_COLUMNS}, event_time FROM sent
    WHERE fault = 0 AND event_type <> 'error'"""
)
def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(clean(bronze_batch(spark, sf_dir)).select(*FIELDS, "event_time"))


@query(_SILVER)
def silver_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(to_silver(bronze_batch(spark, sf_dir)))


@query(_SILVER)
def silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(streamed(spark, sf_dir, "silver_stream").into_bronze().into_silver().silver())


@query(_SILVER)
def silver_stream_unsalted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dedupe in a single pass, said outright."""
    run = streamed(spark, sf_dir, "silver_stream_unsalted").into_bronze()
    return presented(run.into_silver(dedupe={"copy_salts": 0}).silver())


@query(_SILVER)
def silver_stream_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of an id spread over as many salts as there are state partitions first."""
    run = streamed(spark, sf_dir, "silver_stream_salted").into_bronze()
    return presented(run.into_silver(dedupe={"copy_salts": None}).silver())


@query(_SILVER)
def silver_stream_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dedupe with bounded state. The copies come after all originals are through: those the
    state has forgotten by then lie behind the watermark and are dropped for that."""
    records = faulty_records(source_events(spark, sf_dir))
    run = Run(spark, "silver_stream_bounded").land(records.where("partition <> 3")).into_bronze()
    run.into_silver(dedupe={"mode": "within_watermark"}).land(records.where("partition = 3"))
    return presented(run.into_bronze().into_silver(dedupe={"mode": "within_watermark"}).silver())


@query(f"WITH {_FEED} SELECT {_EVENT_COLUMNS}, event_time FROM faulty_silver")
def compacted_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver with its closed dates rewritten beside the stream, between two arrivals."""
    run, rest = two_halves(spark, sf_dir, "compacted_silver")
    run.into_bronze().into_silver()
    compact_silver(spark, run.layout)
    run.land(rest).into_bronze().into_silver()
    compact_silver(spark, run.layout)
    return presented(run.silver())


@query(
    f"""WITH {_FEED}
    SELECT layer, CAST(count(*) AS BIGINT) AS rows,
           {', '.join(f'CAST(count(*) - count("{f}") AS BIGINT) AS no_{f}' for f in FIELDS)}
    FROM (SELECT 'bronze' AS layer, {_EVENT_COLUMNS} FROM decoded
          UNION ALL SELECT 'silver', {_EVENT_COLUMNS} FROM faulty_silver)
    GROUP BY layer"""
)
def silver_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = stored(bronze_batch(spark, sf_dir), "silver_audit")
    return quality.silver_audit(bronze, to_silver(bronze))


# The lagging partition comes when the watermark stands 10 minutes behind the newest event of
# the others, cut to milliseconds.
@query(
    f"""WITH {_FEED}, seen AS (
        SELECT * FROM sent WHERE p <> 2 AND fault = 0 AND event_type <> 'error'
    ), edge AS (
        SELECT (max(epoch_us(event_time)) // 1000 - 600000) * 1000 AS us FROM seen
    ), newest AS (
        SELECT max(epoch_us(event_time)) AS us FROM faulty_silver
    )
    SELECT event_id, event_time, CAST(1 AS BIGINT) AS copies,
           ((SELECT us FROM newest) - epoch_us(event_time)) // 1000000 AS behind_s
    FROM faulty_silver
    WHERE n % 3 = 2 AND event_id NOT IN (SELECT event_id FROM seen)
      AND epoch_us(event_time) <= (SELECT us FROM edge)"""
)
def lost_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One broker partition lags: its records come after the others are through, and silver
    refuses what is behind its watermark. All of those must show up as lost."""
    records = faulty_records(source_events(spark, sf_dir))
    run = Run(spark, "lost_events").land(records.where("partition <> 2")).into_bronze()
    run.into_silver().land(records.where("partition = 2")).into_bronze().into_silver()
    return presented(quality.lost_events(run.bronze(), run.silver()))


# -- Session metrics -----------------------------------------------------------------------


@query(f"{_CLEAN_GOLD} SELECT {_GOLD_COLUMNS} FROM gold")
def gold_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(session_metrics(clean_silver(spark, sf_dir)))


@query(f"{_FAULTY_GOLD} SELECT {_GOLD_COLUMNS} FROM gold WHERE {_CLOSED}")
def gold_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three layers as streams; windows still open at the end are not in gold."""
    run = streamed(spark, sf_dir, "gold_stream").into_bronze().into_silver().into_gold()
    return presented(run.gold().snapshot())


_WINDOWS = """, marked AS (
    SELECT *, CASE WHEN event_time - lag(event_time) OVER w <= INTERVAL '30 minutes'
                   THEN 0 ELSE 1 END AS starts
    FROM {silver} WINDOW w AS (PARTITION BY user_id ORDER BY event_time)
), numbered AS (
    SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY event_time
                                RANGE UNBOUNDED PRECEDING) AS nth
    FROM marked
), windows AS (
    SELECT user_id, min(event_time) AS window_start,
           max(event_time) + INTERVAL '30 minutes' AS window_end, count(*) AS events,
           {metrics}
    FROM numbered GROUP BY user_id, nth
)
SELECT user_id, window_start, window_end, events, page_views, cart_adds, purchases,
       round(revenue, 2) AS revenue
FROM windows"""


@query(f"WITH {_FEED}{_WINDOWS.format(silver='clean_silver', metrics=_METRICS)}")
def session_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(activity_windows(stored_silver(spark, sf_dir)))


@query(
    f"WITH {_FEED}{_WINDOWS.format(silver='faulty_silver', metrics=_METRICS)} WHERE {_CLOSED}"
)
def session_windows_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = streamed(spark, sf_dir, "session_windows").into_bronze().into_silver()
    rows = activity_windows(stream_layer(spark, run.layout, "silver", SILVER_SCHEMA))
    path = run.layout.table("activity")
    start(rows, run.layout.checkpoint("activity"), path, **run.run).awaitTermination()
    return presented(read_table(spark, path, rows.schema))


@query(
    f"""{_CLEAN_GOLD}
    SELECT session_id, CAST(sum(page_views) AS BIGINT) AS page_views,
           CAST(sum(cart_adds) AS BIGINT) AS cart_adds,
           CAST(sum(purchases) AS BIGINT) AS purchases
    FROM gold GROUP BY session_id"""
)
def session_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnels.session_rollup(session_metrics(stored_silver(spark, sf_dir)))


@query(
    f"""WITH {_FEED}, state AS (
        SELECT session_id, min(event_time) AS first_event, max(event_time) AS last_event,
               count(*) AS events, {_METRICS}
        FROM faulty_silver GROUP BY session_id
    )
    SELECT session_id, first_event, last_event, events, page_views, cart_adds, purchases,
           round(revenue, 2) AS revenue FROM state"""
)
def session_state_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session table after two arrivals: its stored rows, none grouped."""
    run, rest = two_halves(spark, sf_dir, "session_state")
    run.into_bronze().into_silver().into_sessions()
    run.land(rest).into_bronze().into_silver()
    return presented(run.into_sessions().current())


# -- Funnel --------------------------------------------------------------------------------


@query(f"{_CLEAN_GOLD}{_funnel_sql('gold')}")
def funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnels.funnel(session_metrics(clean_silver(spark, sf_dir))).drop("gold_version")


_CLOSED_GOLD = f"{_FAULTY_GOLD}, closed AS (SELECT * FROM gold WHERE {_CLOSED})"


@query(f"{_CLOSED_GOLD}{_funnel_sql('closed')}")
def funnel_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streamed gold table, as a view of its newest batch, asked in SQL."""
    run = streamed(spark, sf_dir, "funnel_sql").into_bronze().into_silver().into_gold()
    with registered(spark, funnel_gold=run.gold().snapshot()):
        return sql.run_sql(spark, sql.FUNNEL, gold="funnel_gold")


@query(
    f"""{_CLOSED_GOLD}
    SELECT 'silver' AS layer, count(*) AS rows, count(DISTINCT session_id) AS sessions,
           round(sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0.0 END), 2) AS revenue
    FROM faulty_silver
    UNION ALL
    SELECT 'gold', count(*), count(DISTINCT session_id), round(sum(revenue), 2) FROM closed
    UNION ALL
    SELECT 'sessions', count(DISTINCT session_id), count(DISTINCT session_id),
           round(sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0.0 END), 2)
    FROM faulty_silver
    UNION ALL
    SELECT 'top products', least(count(DISTINCT product_id), 10), 0, (
        SELECT round(sum(revenue), 2) FROM (
            SELECT sum(price) AS revenue FROM faulty_silver WHERE event_type = 'purchase'
            GROUP BY product_id ORDER BY revenue DESC, product_id LIMIT 10))
    FROM faulty_silver WHERE event_type = 'purchase'"""
)
def layers_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver, gold, the session table and a report, each from where its stream keeps it."""
    run = streamed(spark, sf_dir, "layers_sql").into_bronze().into_silver().into_gold()
    silver = stream_layer(spark, run.layout, "silver", SILVER_SCHEMA)
    report, query = start_refresh(spark, silver, "top", refresh.TOP_PRODUCTS, run.layout, **run.run)
    query.awaitTermination()
    views = {
        "l_silver": run.silver(),
        "l_gold": run.gold().snapshot(),
        "l_sessions": run.into_sessions().current(),
        "l_top": report.shown(),
    }
    with registered(spark, **views):
        return spark.sql(
            """
            SELECT 'silver' AS layer, count(*) AS rows, count(DISTINCT session_id) AS sessions,
                   round(sum(if(event_type = 'purchase', price, 0)), 2) AS revenue FROM l_silver
            UNION ALL
            SELECT 'gold', count(*), count(DISTINCT session_id), round(sum(revenue), 2) FROM l_gold
            UNION ALL
            SELECT 'sessions', count(*), count(*), round(sum(revenue), 2) FROM l_sessions
            UNION ALL
            SELECT 'top products', count(*), 0, round(sum(revenue), 2) FROM l_top"""
        )


@query(
    f"""{_CLOSED_GOLD}
    SELECT (SELECT count(*) FROM closed) AS windows,
           (SELECT round(sum(revenue), 2) FROM closed) AS gold_revenue,
           count(DISTINCT session_id) AS sessions, count(*) AS events,
           round(sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0.0 END), 2) AS revenue
    FROM faulty_silver"""
)
def published_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold and the session table as views of the catalogue, given anew after each arrival; plain
    SQL reads what the last one published."""
    run, rest = two_halves(spark, sf_dir, "published_views")
    for arrival in (None, rest):
        if arrival is not None:
            run.land(arrival)
        run.into_bronze().into_silver().into_gold()
        publish_view(spark, "published_gold", run.gold().query())
        publish_view(spark, "published_sessions", run.into_sessions().query())
    return spark.sql(
        """
        SELECT g.*, s.* FROM
          (SELECT count(*) AS windows, round(sum(revenue), 2) AS gold_revenue FROM published_gold) g,
          (SELECT count(*) AS sessions, sum(events) AS events, round(sum(revenue), 2) AS revenue
           FROM published_sessions) s"""
    )


@query(
    f"""{_CLOSED_GOLD}{_funnel_sql('closed').replace('SELECT *,', 'SELECT viewed_sessions, carted_sessions, purchased_sessions,')}"""
)
def funnel_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the command line's funnel prints over streamed layers, read back from its lines."""
    from sessionloom import __main__ as jobs

    run = streamed(spark, sf_dir, "funnel_job").into_bronze().into_silver().into_gold()
    out = io.StringIO()
    with redirect_stdout(out):
        jobs.funnel_report(spark, jobs.parse(["funnel", "--base", run.layout.base]))
    lines = dict(line.split("=", 1) for line in out.getvalue().splitlines())
    numbers = {name: F.lit(text).cast("double" if name.endswith("rate") else "long") for name, text in lines.items()}
    return spark.range(1).select(*[value.alias(name) for name, value in numbers.items() if name != "gold_version"])


@query(
    f"""{_CLOSED_GOLD}
    SELECT 'bronze' AS layer, count(*) AS rows FROM sent
    UNION ALL SELECT 'silver', count(*) FROM faulty_silver
    UNION ALL SELECT 'gold', count(*) FROM closed"""
)
def layer_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each layer where the layout says it lies, and nothing beside them."""
    run = streamed(spark, sf_dir, "layer_paths").into_bronze().into_silver().into_gold()
    found = []
    for layer in children(spark, f"{run.layout.base}/tables"):
        folder = run.layout.table(layer) + ("/batches" if layer == "gold" else "")
        rows = spark.read.parquet(folder)
        found.append(rows.agg(F.lit(layer).alias("layer"), F.count("*").alias("rows")))
    return reduce(DataFrame.unionByName, found)


def _two_versions(spark: SparkSession, sf_dir: str, name: str) -> tuple[BatchTable, int]:
    """Gold after both halves, and its newest batch after the first."""
    run, rest = two_halves(spark, sf_dir, name)
    pinned = run.into_bronze().into_silver().into_gold().gold().latest_version()
    run.land(rest).into_bronze().into_silver().into_gold()
    return run.gold(), pinned


_EARLY_GOLD = f"""{_FAULTY_GOLD}, early_gold AS (SELECT * FROM gold WHERE {_CLOSED_EARLY})"""


@query(f"{_EARLY_GOLD}{_funnel_sql('early_gold')}")
def funnel_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Funnel of a pinned batch, read after later ones were committed."""
    gold, pinned = _two_versions(spark, sf_dir, "funnel_snapshot")
    return funnels.funnel(gold.snapshot(pinned), pinned).drop("gold_version")


@query(
    f"""{_EARLY_GOLD}
    SELECT (SELECT count(*) FROM early_gold) AS rows_left, count(*) AS rows_right,
           CAST(0 AS BIGINT) AS only_left,
           count(*) - (SELECT count(*) FROM early_gold) AS only_right
    FROM gold WHERE {_CLOSED}"""
)
def snapshot_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later batch has all rows of an earlier one, and more."""
    gold, pinned = _two_versions(spark, sf_dir, "snapshot_growth")
    return quality.compare_tables(gold.snapshot(pinned), gold.snapshot())


@query(
    f"""{_FAULTY_GOLD}
    SELECT {_GOLD_COLUMNS}, CAST(1 AS BIGINT) AS surplus FROM gold
    WHERE {_CLOSED} AND NOT {_CLOSED_EARLY}"""
)
def version_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the newest batch has that an earlier one had not."""
    gold, pinned = _two_versions(spark, sf_dir, "version_diff")
    return presented(quality.changed_rows(gold.snapshot(), gold.snapshot(pinned)))


@query(
    f"""WITH {_FEED}, {_gold('faulty_silver')}{_funnel_sql('gold')}"""
)
def funnel_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Funnel kept by a stream: over the session table, so without waiting for windows."""
    run, rest = two_halves(spark, sf_dir, "funnel_stream")
    run.into_bronze().into_silver().into_sessions()
    run.land(rest).into_bronze().into_silver()
    return run.into_sessions().funnel().drop("gold_version")


# -- Reports -------------------------------------------------------------------------------

_ENRICHED = """
    SELECT s.event_id, s.session_id, s.event_type, s.product_id, s.price,
           p.p_name AS product_name, p.p_brand AS brand, p.p_type AS category
    FROM {silver} s LEFT JOIN part p ON s.product_id = 'prod_' || p.p_partkey"""
_ENRICHED_COLUMNS = (
    "event_id", "session_id", "event_type", "product_id", "price",
    "product_name", "brand", "category",
)


@query(f"WITH {_FEED}{_ENRICHED.format(silver='clean_silver')}")
def enriched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = stored_silver(spark, sf_dir)
    return enrich(events, product_catalog(spark, sf_dir)).select(*_ENRICHED_COLUMNS)


@query(f"WITH {_FEED}{_ENRICHED.format(silver='clean_silver')}")
def enriched_events_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken when the catalogue is too large to broadcast."""
    events = stored_silver(spark, sf_dir)
    catalogue = product_catalog(spark, sf_dir)
    return enrich(events, catalogue, broadcast_bytes=0).select(*_ENRICHED_COLUMNS)


@query(f"WITH {_FEED}{_ENRICHED.format(silver='faulty_silver')}")
def enriched_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each micro-batch is joined to the catalogue as it is then."""
    run = streamed(spark, sf_dir, "enriched_stream").into_bronze().into_silver()
    silver = stream_layer(spark, run.layout, "silver", SILVER_SCHEMA)
    catalogue = product_catalog(spark, sf_dir)
    empty = enrich(spark.createDataFrame([], SILVER_SCHEMA), catalogue)
    checkpoint = run.layout.checkpoint("enriched")
    table = BatchTable(spark, run.layout.table("enriched"), empty.schema, checkpoint).create()
    joined = enrich_batches(lambda: product_catalog(spark, sf_dir), table.write)
    start(silver, checkpoint, each_batch=joined, **run.run).awaitTermination()
    return table.snapshot().select(*_ENRICHED_COLUMNS)


_HOURLY = """
    SELECT date_trunc('hour', window_start) AS hour, round(sum(revenue), 2) AS revenue,
           CAST(sum(purchases) AS BIGINT) AS purchases
    FROM gold GROUP BY 1"""


@query(f"{_CLEAN_GOLD}{_HOURLY}")
def hourly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(reports.hourly_revenue(session_metrics(stored_silver(spark, sf_dir))))


@query(f"{_CLEAN_GOLD}{_HOURLY}")
def hourly_revenue_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = session_metrics(stored_silver(spark, sf_dir))
    return presented(sql.run_sql(spark, sql.HOURLY_REVENUE, gold=gold))


_TOP = f"""WITH {_FEED}
    SELECT product_id, round(sum(price), 2) AS revenue, count(*) AS purchases
    FROM clean_silver WHERE event_type = 'purchase'
    GROUP BY product_id ORDER BY revenue DESC, product_id LIMIT 10"""


@query(_TOP)
def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(reports.top_products(stored_silver(spark, sf_dir)))


@query(_TOP)
def top_products_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(
        sql.run_sql(spark, sql.TOP_PRODUCTS, silver=stored_silver(spark, sf_dir), n=10)
    )


_DURATIONS = """, durations AS (
    SELECT session_id, min(event_time) AS first_event, max(event_time) AS last_event,
           count(*) AS events,
           (max(epoch_us(event_time)) - min(epoch_us(event_time))) // 1000000 AS duration_s
    FROM {silver} GROUP BY session_id
)"""
_HISTOGRAM = """
    SELECT duration_s - duration_s % 300 AS bucket_start_s, count(*) AS sessions
    FROM durations GROUP BY 1"""


@query(f"WITH {_FEED}{_DURATIONS.format(silver='clean_silver')} SELECT * FROM durations")
def session_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(reports.session_durations(reports.session_spans(stored_silver(spark, sf_dir))))


@query(f"WITH {_FEED}{_DURATIONS.format(silver='clean_silver')}{_HISTOGRAM}")
def duration_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.duration_histogram(stored_silver(spark, sf_dir))


@query(
    f"""WITH {_FEED}{_DURATIONS.format(silver='clean_silver')}
    SELECT count(*) AS sessions, CAST(max(duration_s) AS DOUBLE) AS longest,
           quantile_cont(duration_s, 0.5) AS p50, quantile_cont(duration_s, 0.9) AS p90,
           quantile_cont(duration_s, 0.99) AS p99
    FROM durations"""
)
def duration_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.duration_quantiles(stored_silver(spark, sf_dir))


@query(f"WITH {_FEED}{_DURATIONS.format(silver='faulty_silver')}{_HISTOGRAM}")
def scheduled_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report kept up with silver from the new rows of each batch."""
    run, rest = two_halves(spark, sf_dir, "scheduled_refresh")
    for arrival in (None, rest):
        if arrival is not None:
            run.land(arrival)
        run.into_bronze().into_silver()
        silver = stream_layer(spark, run.layout, "silver", SILVER_SCHEMA)
        report, query = start_refresh(
            spark, silver, "durations", refresh.DURATIONS, run.layout, **run.run
        )
        query.awaitTermination()
    return report.shown()


def _session_reports(spark: SparkSession, sf_dir: str, name: str) -> refresh.SessionReports:
    """Reports of sessions after three arrivals; many sessions are in more than one."""
    run, arrivals = arriving(spark, sf_dir, name, 3)
    for arrival in arrivals:
        run.land(arrival).into_bronze().into_silver()
        kept, live = refresh.start_session_reports(
            spark,
            run.layout,
            {"histogram": refresh.HISTOGRAM, "funnel": refresh.FUNNEL},
            **run.run,
        )
        live.awaitTermination()
    return kept


@query(f"WITH {_FEED}{_DURATIONS.format(silver='faulty_silver')}{_HISTOGRAM}")
def live_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of durations kept by retractions: a session that grows leaves its bucket."""
    return _session_reports(spark, sf_dir, "live_histogram").shown("histogram")


@query(
    f"""WITH {_FEED}{_DURATIONS.format(silver='faulty_silver')}
    SELECT unnest([0.5, 0.9, 0.99])::DOUBLE AS quantile,
           unnest(quantile_cont(duration_s, [0.5, 0.9, 0.99])) AS exact, true AS within
    FROM durations"""
)
def sketch_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles by sketches of the session table's buckets after three arrivals, held against
    the exact ones: whether each lies within the sketch's bound."""
    kept = _session_reports(spark, sf_dir, "sketch_quantiles")
    return kept.sketches.checked(reports.session_durations(kept.state.current()))


@query(f"""WITH {_FEED}, {_gold('faulty_silver')}{_funnel_sql('gold')}""")
def live_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Funnel kept by retractions: from counts of sessions, not from sessions."""
    return _session_reports(spark, sf_dir, "live_funnel").shown("funnel").drop("gold_version")


@query(f"WITH {_FEED}, {_gold('faulty_silver')}{_HOURLY}")
def live_hourly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly revenue kept up with silver, without waiting for windows of gold to close."""
    run, rest = two_halves(spark, sf_dir, "live_hourly_revenue")
    for arrival in (None, rest):
        if arrival is not None:
            run.land(arrival)
        run.into_bronze().into_silver()
        silver = stream_layer(spark, run.layout, "silver", SILVER_SCHEMA)
        report, live = start_refresh(
            spark, silver, "hourly", refresh.HOURLY_REVENUE, run.layout, **run.run
        )
        live.awaitTermination()
    return presented(report.shown())


# -- Tables and audits ---------------------------------------------------------------------


@query(
    f"""WITH {_FEED}
    SELECT count(*) AS rows_left, count(*) AS rows_right,
           CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right
    FROM clean_silver"""
)
def round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written, replaced and read back holds the same rows."""
    path = f"{scratch_dir(spark, 'round_trip')}/silver"
    silver = stored_silver(spark, sf_dir)
    replace_table(silver.limit(0), path)
    replace_table(silver, path)
    return quality.compare_tables(silver, read_table(spark, path, SILVER_SCHEMA))


@query(f"{_CLEAN_GOLD} SELECT {_GOLD_COLUMNS} FROM gold")
def compacted_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold with its first batches folded into sorted files and a later one beside them."""
    path = f"{scratch_dir(spark, 'compacted')}/gold"
    gold = BatchTable(spark, path, GOLD_SCHEMA, clock="window_start", fold_every=2).create()
    rows = session_metrics(stored_silver(spark, sf_dir))
    part = F.pmod(F.xxhash64("session_id", "window_start"), F.lit(3))
    for batch in range(3):
        gold.write(rows.where(part == batch), batch)
    gold.compact(["session_id", "window_start"])
    return presented(gold.snapshot())


@query(
    f"""WITH {_FEED} SELECT CAST(0 AS BIGINT) AS differing_sessions,
           count(DISTINCT session_id) AS sessions FROM clean_silver"""
)
def gold_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = stored_silver(spark, sf_dir)
    gold = stored(session_metrics(silver), "gold_reconcile")
    differing = quality.gold_reconcile(silver, gold).agg(F.count("*").alias("differing_sessions"))
    sessions = gold.agg(F.count_distinct("session_id").alias("sessions"))
    return differing.select("differing_sessions", sessions.scalar().alias("sessions"))


# Silver of a feed whose partition 2 comes after the others, which loses what lies behind the
# watermark by then.
_LAGGING = """, seen AS (
        SELECT * FROM sent WHERE p <> 2 AND fault = 0 AND event_type <> 'error'
    ), edge AS (
        SELECT (max(epoch_us(event_time)) // 1000 - 600000) * 1000 AS us FROM seen
    ), lost AS (
        SELECT * FROM faulty_silver
        WHERE n % 3 = 2 AND event_id NOT IN (SELECT event_id FROM seen)
          AND epoch_us(event_time) <= (SELECT us FROM edge)
    ), lagging_silver AS (
        SELECT * FROM faulty_silver WHERE event_id NOT IN (SELECT event_id FROM lost)
    )"""


@query(
    f"""WITH {_FEED}{_LAGGING}, {_gold('lagging_silver')}, totals AS (
        SELECT (SELECT count(*) FROM sent) AS bronze,
               (SELECT count(*) FROM sent WHERE fault <> 0) AS missing_field,
               (SELECT count(*) FROM sent WHERE fault = 0 AND event_type = 'error') AS unknown_type,
               (SELECT count(*) FROM sent WHERE fault = 0 AND event_type <> 'error') AS valid,
               (SELECT count(*) FROM faulty_silver) AS distinct_valid,
               (SELECT count(*) FROM lagging_silver) AS silver,
               (SELECT count(*) FROM lagging_silver
                WHERE event_type IN ('page_view', 'add_to_cart', 'purchase')) AS countable,
               (SELECT coalesce(sum(page_views + cart_adds + purchases), 0) FROM gold
                WHERE window_end <= (SELECT max(event_time) FROM lagging_silver)
                      - INTERVAL '2 minutes') AS counted
    )
    SELECT unnest(['1_bronze', '2_missing_field', '3_unknown_type', '4_repeated', '5_late',
                   '6_silver', '7_counted_in_gold', '8_in_open_windows']) AS step,
           unnest([bronze, missing_field, unknown_type, valid - distinct_valid,
                   distinct_valid - silver, silver,
                   CAST(counted AS BIGINT), CAST(countable - counted AS BIGINT)]) AS rows
    FROM totals"""
)
def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every layer streamed, one broker partition lagging, then reconciled end to end."""
    records = faulty_records(source_events(spark, sf_dir))
    run = Run(spark, "layer_counts").land(records.where("partition <> 2")).into_bronze()
    run.into_silver().land(records.where("partition = 2")).into_bronze().into_silver().into_gold()
    return quality.layer_counts(run.bronze(), run.silver(), run.gold().snapshot())


def _lagging(spark: SparkSession, sf_dir: str, name: str) -> Run:
    """Layers of a feed whose partition 2 comes last, their progress recorded."""
    records = faulty_records(source_events(spark, sf_dir))
    run = Run(spark, name)
    with ProgressLog(spark, run.layout):
        run.land(records.where("partition <> 2")).into_bronze().into_silver(name="silver")
        run.land(records.where("partition = 2")).into_bronze().into_silver(name="silver").into_gold()
    return run


@query(
    f"""WITH {_FEED}{_LAGGING}, late AS (
        SELECT event_id, event_id IN (SELECT event_id FROM seen) AS known FROM sent
        WHERE p = 2 AND fault = 0 AND event_type <> 'error'
          AND epoch_us(event_time) <= (SELECT us FROM edge)
    )
    SELECT (SELECT count(*) FROM sent) AS rows_in, count(*) AS dropped,
           count(*) FILTER (WHERE known) AS copies, (SELECT count(*) FROM lost) AS lost
    FROM late"""
)
def late_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the running dedupe refused as late, by the engine's count. Some are copies of events
    that silver has; the others are lost, and are the step ``5_late`` of ``layer_counts``."""
    run = _lagging(spark, sf_dir, "late_drops")
    engine = progress.late_drops(spark, run.layout, "silver")
    counts = quality.layer_counts(run.bronze(), run.silver(), run.gold().snapshot())
    lost = counts.where("step = '5_late'").select("rows").scalar()
    found = engine.withColumn("lost", lost)
    return found.select("rows_in", "dropped", F.expr("dropped - lost").alias("copies"), "lost")


@query(
    f"""WITH {_FEED}{_LAGGING}, {_gold('lagging_silver')}, open AS (
        SELECT * FROM gold
        WHERE window_end > (SELECT max(event_time) FROM lagging_silver) - INTERVAL '2 minutes'
    )
    SELECT count(*) AS open_windows,
           CAST(coalesce(sum(page_views + cart_adds + purchases), 0) AS BIGINT)
               AS events_in_open_windows,
           (SELECT count(*) FROM lagging_silver) AS remembered_ids
    FROM open"""
)
def open_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the queries hold in their state: the events in open windows are the step
    ``8_in_open_windows`` of ``layer_counts``, which is a difference there."""
    return state_audit(spark, _lagging(spark, sf_dir, "open_state").layout)


@query(
    f"""WITH {_FEED}{_LAGGING}, {_gold('lagging_silver')}
    SELECT session_id, window_start, window_end, page_views, cart_adds, purchases,
           round(revenue, 2) AS revenue
    FROM gold
    WHERE window_end > (SELECT max(event_time) FROM lagging_silver) - INTERVAL '2 minutes'"""
)
def open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows gold has not emitted, with their metrics so far."""
    run = _lagging(spark, sf_dir, "open_windows")
    return presented(state_tables.open_windows(spark, run.layout))
