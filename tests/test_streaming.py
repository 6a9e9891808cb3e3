import os
import random
import shutil
import time
from datetime import datetime

import pytest
from helpers import (
    T0,
    collect_batches,
    event,
    land,
    plan,
    record,
    rows,
    silver,
    silver_row,
    stream_of,
    stream_records,
)
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.functions.contract import event_schema
from sessionloom.operators.enrich import enrich, enrich_batches
from sessionloom.operators.funnel import funnel
from sessionloom.operators.gold import activity_windows, session_metrics
from sessionloom.operators.quality import compare_tables, layer_counts, lost_events
from sessionloom.operators.reports import duration_histogram, hourly_revenue, session_durations
from sessionloom.operators.silver import dedupe, to_silver
from sessionloom.plans.feed import faulty_records, source_events
from sessionloom.plans.runs import arriving, first_half, parts_of
from sessionloom.sources.batches import BatchTable
from sessionloom.sources.broker import BROKER_SCHEMA, stream_record_files
from sessionloom.sources.tables import (
    BRONZE_SCHEMA,
    SILVER_SCHEMA,
    Layout,
    compact_silver,
    dated,
    read_layer,
    read_table,
    silver_schema,
    stream_table,
)
from sessionloom.streaming.layers import (
    ONCE,
    gold_table,
    run_all,
    start,
    start_bronze,
    start_gold,
    start_silver,
    stream_layer,
)
from sessionloom.streaming.progress import ProgressLog, late_drops, progress_row, read_progress
from sessionloom.streaming.publish import read_published, start_publish
from sessionloom.streaming.refresh import (
    DURATIONS,
    FUNNEL,
    HISTOGRAM,
    HOURLY_REVENUE,
    TOP_PRODUCTS,
    DurationSketches,
    start_refresh,
    start_session_reports,
)
from sessionloom.streaming.sessions import SessionState, start_session_state
from sessionloom.streaming.state import open_windows, state_audit

# (id, seconds after T0), one micro-batch per list.
ARRIVALS = [
    [("a", 0)],
    [("b", 3600)],
    [("c", 100)],
    [("c2", 3000), ("c3", 3000.001)],
    [("a", 3601)],
    [("n", None)],
    [("z", 7200)],
]


def emitted_by_batch(spark, base, batches, transform):
    """Land each batch and run the stream over it to the end, on one checkpoint. Every run ends
    with the watermark its rows have set."""
    emitted = []
    for batch in batches:
        land(silver(spark, *[silver_row(**row) for row in batch]), f"{base}/in")
        stream = transform(stream_of(spark, f"{base}/in", SILVER_SCHEMA))
        found = collect_batches(stream, f"{base}/c")
        emitted.append(sorted(row for rows_ in found for row in rows_))
    return emitted


def dedupe_run(spark, base, **options):
    batches = [[{"id": i, "seconds": s} for i, s in batch] for batch in ARRIVALS]

    def kept(stream):
        placed = stream.withColumns({"kafka_partition": F.lit(0), "kafka_offset": F.lit(0)})
        return dedupe(placed, **options).select("event_id", "event_time")

    return [row[0] for batch in emitted_by_batch(spark, base, batches, kept) for row in batch]


def test_dedupe_remembers_every_id(spark, base):
    assert dedupe_run(spark, base) == ["a", "b", "c3", "n", "z"]


def test_dedupe_within_watermark_forgets(spark, base):
    assert dedupe_run(spark, base, mode="within_watermark") == ["a", "b", "c3", "a", "n", "z"]


def test_unsalted_dedupe_keeps_the_same(spark, base):
    assert dedupe_run(spark, base, copy_salts=0) == ["a", "b", "c3", "n", "z"]


def test_salted_dedupe_keeps_the_same(spark, base):
    assert dedupe_run(spark, base, copy_salts=8) == ["a", "b", "c3", "n", "z"]


def test_salted_dedupe_of_a_hot_id(spark, base):
    hot = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).otherwise("hot").alias("event_id"),
        F.timestamp_seconds(F.lit(T0) + F.col("id") % 7).alias("event_time"),
        F.lit(0).alias("kafka_partition"),
        F.col("id").alias("kafka_offset"),
    )
    land(hot, f"{base}/in")
    stream = stream_of(spark, f"{base}/in", hot.schema)
    salted = dedupe(stream, copy_salts=None).select("event_id")
    kept = collect_batches(salted, f"{base}/c")
    assert len(kept[0]) == len({i for (i,) in kept[0]}) == 1_001


def gold_run(spark, base, *batches):
    names = ("seconds", "session", "kind", "price")
    made = [[dict(zip(names, row)) for row in batch] for batch in batches]

    def metrics(stream):
        return session_metrics(stream).selectExpr(
            "session_id", f"unix_seconds(window_start) - {T0}", "page_views", "purchases", "revenue"
        )

    return emitted_by_batch(spark, base, made, metrics)


def test_gold_batches(spark, base):
    got = gold_run(
        spark,
        base,
        [(0, "A", "page_view", 1), (299.9, "A", "purchase", 9.5), (10, "B", "search", 1)],
        [(300, "A", "page_view", 1)],
        [(420, "A", "page_view", 1)],
        [(100, "A", "page_view", 1), (419, "A", "page_view", 1)],
        [(2000, "A", "page_view", 1)],
    )
    closed = [("A", 0, 1, 1, 9.5), ("B", 0, 0, 0, 0.0)]
    assert got == [[], [], closed, [], [("A", 300, 3, 0, 0.0)]]


def test_open_window_takes_late_rows(spark, base):
    got = gold_run(spark, base, *[[(s, "A", "page_view", 1)] for s in (520, 350, 5000)])
    assert got == [[], [], [("A", 300, 2, 0, 0.0)]]


def test_session_window_stream(spark, base):
    for seconds in (0, 1800, 3600.000001, 9000):
        land(silver(spark, silver_row(seconds)), f"{base}/in")
    windows = activity_windows(stream_of(spark, f"{base}/in", SILVER_SCHEMA)).selectExpr(
        f"unix_seconds(window_start) - {T0}", "events"
    )
    got = sorted(row for batch in collect_batches(windows, f"{base}/c") for row in batch)
    assert got == [(0, 2), (3600, 1)]


def sends(spark, specs):
    made = [record(event(s, event_id=i), p, o, s) for i, s, p, o in specs]
    return spark.createDataFrame(made, BROKER_SCHEMA)


def test_restart_neither_loses_nor_repeats(spark, base):
    layout = Layout(base)
    land(sends(spark, [("a", 0, 0, 0), ("b", 1, 1, 0)]), f"{base}/in")
    for _ in range(2):
        run_all(spark, stream_records(spark, f"{base}/in"), layout, state_partitions=2)
    land(sends(spark, [("c", 9000, 0, 1), ("a", 9001, 0, 2)]), f"{base}/in")
    run_all(spark, stream_records(spark, f"{base}/in"), layout, state_partitions=2)

    bronze = read_layer(spark, layout, "bronze", BRONZE_SCHEMA)
    assert rows(bronze.select("event_id", "kafka_offset")) == [
        ("a", 0), ("a", 2), ("b", 0), ("c", 1)
    ]
    layer = read_layer(spark, layout, "silver", SILVER_SCHEMA)
    assert rows(layer.select("event_id")) == [("a",), ("b",), ("c",)]
    gold = gold_table(spark, layout)
    assert rows(gold.snapshot().select("session_id", "page_views")) == [("s1", 2)]
    assert funnel(gold.snapshot()).first()["viewed_sessions"] == 1


def test_replay_from_the_earliest_record(spark, base):
    land(sends(spark, [("a", 0, 0, 0), ("b", 1, 1, 0)]), f"{base}/in")
    land(spark.createDataFrame([record("broken", 0, 1)], BROKER_SCHEMA), f"{base}/in")
    for name in ("one", "two"):
        start_bronze(
            stream_record_files(spark, f"{base}/in"), Layout(f"{base}/{name}"), trigger=ONCE
        ).awaitTermination()
    tables = [
        read_layer(spark, Layout(f"{base}/{n}"), "bronze", BRONZE_SCHEMA)
        for n in ("one", "two")
    ]
    assert rows(compare_tables(*tables)) == [(3, 3, 0, 0)]


def test_late_copies_show_up_as_lost(spark, base):
    layout = Layout(base)
    run = {"trigger": ONCE, "state_partitions": 2}
    batches = [
        [("a", 5000, 0, 0)],
        [("b", 100, 0, 1), ("b", 100, 0, 2), ("c", 4999, 0, 3)],
    ]
    for batch in batches:
        land(sends(spark, batch), f"{base}/in")
        start_bronze(stream_records(spark, f"{base}/in"), layout, **run).awaitTermination()
        start_silver(spark, layout, **run).awaitTermination()
    bronze = read_layer(spark, layout, "bronze", BRONZE_SCHEMA)
    layer = read_layer(spark, layout, "silver", SILVER_SCHEMA)
    lost = lost_events(bronze, layer).select("event_id", "copies", "behind_s")
    assert rows(lost) == [("b", 2, 4900)]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(0, 10_000), st.integers(1, 4))
def test_stream_equals_batch_however_it_is_split(spark, tmp_path_factory, seed, files):
    """In event-time order, copies of an id in any batch, up to the windows still open."""
    base = str(tmp_path_factory.mktemp("split"))
    pick = random.Random(seed)
    kinds = ["page_view", "add_to_cart", "remove_from_cart", "purchase", "search"]
    # Copies of an id are equal but for their place in the log, which silver does not keep.
    events = [
        event(s, event_id=f"e{i}", session_id=f"s{i % 3}", event_type=pick.choice(kinds))
        for i, s in enumerate(sorted(pick.randint(0, 500) for _ in range(40)))
    ]
    arrivals = events + [pick.choice(events) for _ in range(20)]
    # Within the watermark's delay of each other, so that none is late.
    pick.shuffle(arrivals)
    made = [record(e, 0, i, i) for i, e in enumerate(arrivals)]
    size = -(-len(made) // files)
    for i in range(0, len(made), size):
        land(spark.createDataFrame(made[i : i + size], BROKER_SCHEMA), f"{base}/in")
    run_all(spark, stream_records(spark, f"{base}/in"), Layout(base), state_partitions=2)

    layer = read_layer(spark, Layout(base), "silver", SILVER_SCHEMA)
    bronze = read_layer(spark, Layout(base), "bronze", BRONZE_SCHEMA)
    assert rows(layer) == rows(to_silver(bronze))
    closed = session_metrics(layer).where(
        F.col("window_end") <= F.timestamp_seconds(F.lit(T0 + max(
            r["timestamp"] - T0 for r in layer.collect()) - 120))
    )
    assert rows(gold_table(spark, Layout(base)).snapshot()) == rows(closed)


def land_silver(df, layout):
    part = dated(df.coalesce(1), "event_time")
    part.write.mode("append").partitionBy("event_date").parquet(layout.table("silver"))


def test_session_state_is_kept_once(spark, base):
    layout = Layout(base)
    for i, session in enumerate(["s1", "s2", "s1", "s1", "s3"]):
        land_silver(silver(spark, silver_row(i * 60, session, "purchase", 2.0, f"e{i}")), layout)
    run = {"trigger": ONCE, "buckets": 8, "max_files_per_trigger": 1}
    state, query = start_session_state(spark, layout, **run)
    query.awaitTermination()
    expected = [("s1", 3, 3, 6.0), ("s2", 1, 1, 2.0), ("s3", 1, 1, 2.0)]
    shown = ("session_id", "events", "purchases", "revenue")
    assert rows(state.current().select(*shown)) == expected
    # The stored rows are the sessions: reading groups nothing.
    assert "Exchange" not in plan(state.current()) and "Aggregate" not in plan(state.current())
    # A batch wrote the bucket it touched and no other.
    for i in range(5):
        assert state.versions(i)[1].count(i) == 1
    assert state.versions()[1].count(-1) >= 5

    # A batch handed over again, as after a crash before its checkpoint, changes nothing.
    files = sorted(f for _, _, names in os.walk(f"{base}/tables/sessions") for f in names)
    again = silver(spark, silver_row(240, "s3", "purchase", 2.0, "e4"))
    for kept in (state, SessionState(spark, layout.table("sessions"))):
        kept.upsert(again, 4)
        assert rows(kept.current().select(*shown)) == expected
    assert files == sorted(f for _, _, names in os.walk(f"{base}/tables/sessions") for f in names)
    assert state.funnel().first()["purchased_sessions"] == 3
    assert state.funnel(0).first()["purchased_sessions"] == 1
    assert rows(state.current(2).select(*shown)) == [("s1", 2, 2, 4.0), ("s2", 1, 1, 2.0)]


def test_session_batch_that_was_stopped(spark, base):
    """Data without a manifest is not read; the retry replaces it."""
    state = SessionState(spark, f"{base}/sessions", buckets=4)
    assert state.latest_version() is None and state.current().count() == 0
    state.upsert(silver(spark, silver_row(0, "s1"), silver_row(0, "s2", id="e2")), 0)
    note = state._note
    state._note = lambda *_: 1 / 0
    more = silver(spark, silver_row(60, "s1", id="e3"), silver_row(60, "s3", id="e4"))
    with pytest.raises(ZeroDivisionError):
        state.upsert(more, 1)
    before = [("s1", 1), ("s2", 1)]
    assert rows(state.current().select("session_id", "events")) == before
    os.makedirs(f"{base}/sessions/manifests/batch_id=1")
    state._note = note
    state = SessionState(spark, f"{base}/sessions")
    assert rows(state.current().select("session_id", "events")) == before
    state.upsert(more, 1)
    assert rows(state.current().select("session_id", "events")) == [("s1", 2), ("s2", 1), ("s3", 1)]
    state.upsert(silver(spark), 2)
    changed = state.changes(1).select("session_id", "before.events", F.col("after.events").alias("now"))
    assert rows(changed) == [("s1", 1, 2), ("s3", None, 1)]
    assert state.changes(2).count() == 0
    state.expire(1)
    assert rows(state.current().select("session_id", "events")) == [("s1", 2), ("s2", 1), ("s3", 1)]
    assert rows(state.current(1).select("session_id", "events")) == [("s1", 2), ("s2", 1), ("s3", 1)]
    assert state.versions(0)[0] == -1


def test_reports_of_sessions_by_retractions(spark, base):
    """A session that grows leaves the count it was in; a retried batch counts once."""
    layout = Layout(base)
    reports = {"histogram": HISTOGRAM, "funnel": FUNNEL}
    arrivals = [
        [(0, "s1", "page_view"), (0, "s2", "page_view"), (10, "s3", "purchase")],
        [(400, "s1", "add_to_cart"), (20, "s3", "page_view")],
        [(700, "s1", "purchase"), (900, "s2", "page_view"), (5, "s4", "search")],
    ]
    seen = []
    for i, arrival in enumerate(arrivals):
        made = [silver_row(s, session, kind, 1.0, f"e{i}{n}") for n, (s, session, kind) in enumerate(arrival)]
        land_silver(silver(spark, *made), layout)
        kept, query = start_session_reports(spark, layout, reports, buckets=4, fold_every=2, trigger=ONCE)
        query.awaitTermination()
        seen.append(query.lastProgress["numInputRows"])
        batch = silver(spark, *made)
        kept.refresh(batch, i)
    assert seen == [3, 2, 3]
    layer = silver(spark, *[silver_row(s, x, k, 1.0, "e") for a in arrivals for s, x, k in a])
    assert rows(kept.shown("histogram")) == rows(duration_histogram(layer)) == [(0, 2), (600, 1), (900, 1)]
    wanted = funnel(session_metrics(layer))
    assert rows(kept.shown("funnel")) == rows(wanted)
    assert rows(kept.shown("histogram", 0)) == [(0, 3)]
    # What the second batch wrote: s1 out of one bucket and into the next. s3 stayed where it was.
    added = kept.tables["histogram"].added_rows(0, 1)
    assert rows(added) == [(0, -1), (300, 1)]
    kept.tables["histogram"].compact(["bucket_start_s"])
    assert rows(kept.shown("histogram")) == [(0, 2), (600, 1), (900, 1)]


def test_hourly_revenue_is_kept(spark, base):
    layout = Layout(base)
    for i in range(2):
        made = [silver_row(s, "s", k, 3.0, f"e{i}{s}") for s, k in [(10, "purchase"), (3700 + i, "purchase"), (7300, "page_view"), (None, "purchase")]]
        land_silver(silver(spark, *made), layout)
        changes = stream_layer(spark, layout, "silver", SILVER_SCHEMA)
        table, query = start_refresh(spark, changes, "hourly", HOURLY_REVENUE, layout, trigger=ONCE)
        query.awaitTermination()
    layer = read_layer(spark, layout, "silver", SILVER_SCHEMA)
    assert rows(table.shown()) == rows(hourly_revenue(session_metrics(layer)))
    assert len(rows(table.shown())) == 3


def test_reports_refresh(spark, base):
    layout = Layout(base)

    def refresh(name, report):
        changes = stream_table(spark, layout.table("silver"), dated(silver(spark), "event_time").schema)
        table, query = start_refresh(
            spark, changes.drop("event_date"), name, report, layout, fold_every=1, trigger=ONCE
        )
        query.awaitTermination()
        table.table.compact(table.table.schema.fieldNames()[:1])
        # Rows the last batch was read from.
        read = [p["numInputRows"] for p in query.recentProgress]
        return rows(table.shown()), sum(read)

    land_silver(silver(spark, silver_row(0, kind="purchase")), layout)
    assert refresh("durations", DURATIONS) == ([(0, 1)], 1)
    assert refresh("top", TOP_PRODUCTS) == ([("prod_1", 1.0, 1)], 1)
    land_silver(silver(spark, silver_row(700, kind="purchase", id="e2")), layout)
    assert refresh("durations", DURATIONS) == ([(600, 1)], 1)
    assert refresh("top", TOP_PRODUCTS) == ([("prod_1", 2.0, 2)], 1)


def test_published_once_over_a_restart(spark, base):
    layout = Layout(base)

    def run():
        raw = stream_record_files(spark, f"{base}/in").select(
            F.col("value").cast("string").alias("raw_value")
        )
        query = start_publish(raw, layout, trigger=ONCE)
        query.awaitTermination()
        return query.recentProgress

    land(sends(spark, [("a", 0, 0, 0)]), f"{base}/in")
    land(spark.createDataFrame([record("broken", 0, 1)], BROKER_SCHEMA), f"{base}/in")
    counts = [p["observedMetrics"]["contract"] for p in run()]
    assert [(c["sent"], c["rejected"]) for c in counts] == [(1, 1)]
    land(sends(spark, [("b", 1, 0, 2)]), f"{base}/in")
    run()
    run()
    found = read_published(spark, layout).select(
        "accepted", F.col("value").cast("string").contains("event_id"), "reason", "batch_id"
    )
    assert rows(found) == [
        (False, False, "unparseable JSON", 0), (True, True, "", 0), (True, True, "", 1)
    ]


def test_old_files_are_taken_in(spark, base):
    """A back-filled file may be far older than those already taken."""
    layout = Layout(base)
    land(sends(spark, [("a", 0, 0, 0)]), f"{base}/in")
    start_bronze(stream_records(spark, f"{base}/in"), layout, trigger=ONCE).awaitTermination()
    land(sends(spark, [("b", 1, 0, 1)]), f"{base}/late")
    (name,) = [n for n in os.listdir(f"{base}/late") if n.endswith(".parquet")]
    shutil.copy(f"{base}/late/{name}", f"{base}/in/{name}")
    long_ago = time.time() - 10 * 86_400
    os.utime(f"{base}/in/{name}", (long_ago, long_ago))
    start_bronze(stream_records(spark, f"{base}/in"), layout, trigger=ONCE).awaitTermination()
    bronze = read_layer(spark, layout, "bronze", BRONZE_SCHEMA)
    assert rows(bronze.select("event_id")) == [("a",), ("b",)]


def test_rows_without_a_time_are_in_a_half(spark):
    source = spark.createDataFrame(
        [(datetime(2024, 1, 1),), (datetime(2024, 1, 3),), (None,)], "ts timestamp_ntz"
    )
    early = first_half(source, F.col("ts").cast("timestamp"))
    assert source.where(early).count() + source.where(~early).count() == 3


def test_layers_live_together(spark, base):
    """All three layers run at once while records arrive, a reader beside them."""
    layout = Layout(base)
    run = {"trigger": {"processingTime": "200 milliseconds"}, "state_partitions": 2}
    land(sends(spark, [("a", 0, 0, 0)]), f"{base}/in")
    queries = [start_bronze(stream_records(spark, f"{base}/in"), layout, **run)]
    queries[0].processAllAvailable()
    queries.append(start_silver(spark, layout, **run))
    queries[1].processAllAvailable()
    queries.append(start_gold(spark, layout, **run))
    seen = []
    gold = gold_table(spark, layout)
    try:
        for i in range(1, 4):
            # In order of time; the copy of an id in each arrival, and one row far behind.
            arrival = [(f"e{i}", i * 1000, 0, 2 * i), (f"e{i}", i * 1000, 1, i)]
            land(sends(spark, arrival + ([("old", 1, 0, 99)] if i == 3 else [])), f"{base}/in")
            for query in queries:
                query.processAllAvailable()
            version = gold.latest_version()
            rows_then = gold.snapshot(version).count()
            seen.append((version, rows_then, funnel(gold.snapshot(version)).first()["viewed_sessions"]))
        for query in queries:
            query.processAllAvailable()
    finally:
        for query in reversed(queries):
            query.stop()
    for version, count, viewed in seen:
        assert gold.snapshot(version).count() == count
        assert funnel(gold.snapshot(version)).first()["viewed_sessions"] == viewed
    bronze = read_layer(spark, layout, "bronze", BRONZE_SCHEMA)
    layer = read_layer(spark, layout, "silver", SILVER_SCHEMA)
    account = dict(rows(layer_counts(bronze, layer, gold.snapshot())))
    assert account["1_bronze"] == 8 and account["4_repeated"] == 3
    assert account["5_late"] == 1 and account["6_silver"] == 4
    assert account["7_counted_in_gold"] == 3 and account["8_in_open_windows"] == 1


def test_contract_grows_mid_stream(spark, base):
    layout = Layout(base)
    land(sends(spark, [("a", 0, 0, 0)]), f"{base}/in")
    start_bronze(stream_records(spark, f"{base}/in"), layout, trigger=ONCE).awaitTermination()
    land(
        spark.createDataFrame([record(event(1, event_id="b", channel="app"))], BROKER_SCHEMA),
        f"{base}/in",
    )
    grown = event_schema(strict=False, extra=[T.StructField("channel", T.StringType())])
    start_bronze(
        stream_records(spark, f"{base}/in"), layout, schema=grown, trigger=ONCE
    ).awaitTermination()
    table = read_layer(spark, layout, "bronze", grown)
    assert rows(table.select("event_id", "channel")) == [("a", None), ("b", "app")]
    merged = read_table(spark, layout.table("bronze"), merge_schema=True)
    assert rows(merged.select("event_id", "channel")) == [("a", None), ("b", "app")]
    # The next layer, still on the old schema, is not disturbed.
    start_silver(spark, layout, trigger=ONCE, state_partitions=2).awaitTermination()
    assert read_layer(spark, layout, "silver", SILVER_SCHEMA).count() == 2


def test_stream_enrichment_measures_every_batch(spark, base):
    """A catalogue that has grown beyond the limit is no longer broadcast."""
    sizes, plans = [1, 1000], []

    def catalog():
        size = sizes.pop(0)
        return spark.range(size).select(
            F.concat(F.lit("prod_"), F.col("id") + 1).alias("product_id"),
            F.lit("Lamp").alias("name"),
        )

    table = BatchTable(
        spark, f"{base}/out", T.StructType.fromDDL("event_id string, name string"), f"{base}/c"
    ).create()

    def write(joined, batch_id):
        plans.append(plan(joined))
        table.write(joined, batch_id)

    each = enrich_batches(catalog, write, broadcast_bytes=2000)
    for i in range(2):
        land(silver(spark, silver_row(i, id=f"e{i}")), f"{base}/in")
        stream = stream_of(spark, f"{base}/in", SILVER_SCHEMA)
        start(stream, f"{base}/c", each_batch=each, trigger=ONCE).awaitTermination()
    assert rows(table.snapshot()) == [("e0", "Lamp"), ("e1", "Lamp")]
    assert "BroadcastHashJoin" in plans[0] and "BroadcastHashJoin" not in plans[1]
    with pytest.raises(ValueError):
        enrich(stream_of(spark, f"{base}/in", SILVER_SCHEMA), silver(spark))


def test_runs_until_stopped(spark, base):
    land(sends(spark, [("a", 0, 0, 0)]), f"{base}/in")
    layout = Layout(base)
    query = start_bronze(
        stream_records(spark, f"{base}/in"), layout, trigger={"processingTime": "100 milliseconds"}
    )
    try:
        query.processAllAvailable()
        land(sends(spark, [("b", 0, 0, 1)]), f"{base}/in")
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert read_layer(spark, layout, "bronze", BRONZE_SCHEMA).count() == 2


def test_settings_are_put_back(spark, base):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    land(silver(spark, silver_row(0)), f"{base}/in")
    start(
        dedupe(stream_of(spark, f"{base}/in", SILVER_SCHEMA)),
        f"{base}/c",
        f"{base}/out",
        trigger=ONCE,
        state_partitions=3,
    ).awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_gold_query_restarts_on_its_own(spark, base):
    """Gold takes up silver where it left it, while silver moved on without it."""
    layout = Layout(base)
    for batch in ([("a", 0, 0, 0)], [("b", 400, 0, 1)], [("c", 2000, 0, 2)]):
        land(sends(spark, batch), f"{base}/in")
        run = {"trigger": ONCE, "state_partitions": 2}
        start_bronze(stream_records(spark, f"{base}/in"), layout, **run).awaitTermination()
        start_silver(spark, layout, **run).awaitTermination()
    assert gold_table(spark, layout).create().latest_version() is None
    start_gold(spark, layout, trigger=ONCE, state_partitions=2).awaitTermination()
    assert gold_table(spark, layout).snapshot().count() == 2


@pytest.mark.parametrize("layer", ["bronze", "silver", "gold"])
def test_layout(layer):
    layout = Layout("/x")
    assert layout.table(layer) == f"/x/tables/{layer}"
    assert layout.checkpoint(layer) == f"/x/checkpoints/{layer}"


def test_new_field_reaches_silver_on_the_same_checkpoint(spark, base):
    """Older rows have none, the dedupe still knows their ids, and compaction keeps the field."""
    layout = Layout(base)
    extra = [T.StructField("channel", T.StringType())]
    known, late = event(0, event_id="a"), event(60, event_id="b")
    land(spark.createDataFrame([record(known, 0, 0)], BROKER_SCHEMA), f"{base}/in")
    start_bronze(stream_records(spark, f"{base}/in"), layout, trigger=ONCE).awaitTermination()
    start_silver(spark, layout, trigger=ONCE).awaitTermination()
    again = [{**known, "channel": "web"}, {**late, "channel": "app"}, event(3 * 86_400, event_id="c")]
    rows_in = [record(e, 0, i + 1) for i, e in enumerate(again)]
    land(spark.createDataFrame(rows_in, BROKER_SCHEMA), f"{base}/in")
    start_bronze(stream_records(spark, f"{base}/in"), layout, extra=extra, trigger=ONCE).awaitTermination()
    start_silver(spark, layout, extra=extra, trigger=ONCE).awaitTermination()
    wanted = [("a", None), ("b", "app"), ("c", None)]

    def read():
        return read_layer(spark, layout, "silver", silver_schema(extra))

    assert rows(read().select("event_id", "channel")) == wanted
    # Readers of the old contract see what they saw.
    assert read_layer(spark, layout, "silver", SILVER_SCHEMA).count() == 3
    assert compact_silver(spark, layout, extra=extra) == 1
    assert rows(read().select("event_id", "channel")) == wanted


def test_progress_and_state_of_the_layers(spark, base):
    layout = Layout(base)
    land(sends(spark, [("a", 0, 0, 0), ("b", 7200, 0, 1)]), f"{base}/in")
    with ProgressLog(spark, layout, every=1):
        for arrival in (None, [("a", 0, 0, 2), ("x", 30, 0, 3), ("c", 7210, 0, 4)]):
            if arrival:
                land(sends(spark, arrival), f"{base}/in")
            run = {"trigger": ONCE, "state_partitions": 2}
            start_bronze(stream_records(spark, f"{base}/in"), layout, **run).awaitTermination()
            start_silver(spark, layout, name="silver", **run).awaitTermination()
    start_gold(spark, layout, trigger=ONCE, state_partitions=2).awaitTermination()
    seen = read_progress(spark, layout)
    assert seen.where("name = 'silver'").agg(F.sum("rows_in")).first()[0] == 5
    (found,) = rows(late_drops(spark, layout, "silver"))
    # Both the copy of "a" and "x" are behind the watermark.
    assert found[1:] == (5, 2)
    assert late_drops(spark, layout, "nothing").first()["rows_in"] == 0
    audit = state_audit(spark, layout).first()
    counts = {r["step"]: r["rows"] for r in layer_counts(
        read_layer(spark, layout, "bronze", BRONZE_SCHEMA),
        read_layer(spark, layout, "silver", SILVER_SCHEMA),
        gold_table(spark, layout).snapshot()).collect()}
    assert counts["5_late"] == 1
    assert audit["events_in_open_windows"] == counts["8_in_open_windows"] > 0
    assert audit["remembered_ids"] == counts["6_silver"] == 3
    windows = open_windows(spark, layout).select("session_id", "page_views")
    assert sum(r["page_views"] for r in windows.collect()) == audit["events_in_open_windows"]


def test_a_batch_run_again_is_reported_once(spark, base):
    layout = Layout(base)
    log = ProgressLog(spark, layout)
    report = {"id": "q", "runId": "r", "name": "n", "batchId": 3, "timestamp": "2024-01-01T00:00:00Z",
              "sources": [{"numInputRows": 5}], "stateOperators": [{"numRowsDroppedByWatermark": 2}]}
    log._held = [progress_row(report), progress_row({**report, "timestamp": "2024-01-01T00:00:09Z", "sources": []})]
    log.flush()
    log.flush()
    (row,) = read_progress(spark, layout).collect()
    assert (row["batch_id"], row["rows_in"], row["dropped_by_watermark"]) == (3, 0, 2)
    assert read_progress(spark, Layout(f"{base}/none")).count() == 0


def test_sketches_of_skewed_durations(spark, base):
    """Most sessions of one length, a long tail, sketches far smaller than the sessions; a
    session that grows is in the sketch with its new length alone."""
    state = SessionState(spark, f"{base}/sessions", buckets=4)
    sketches = DurationSketches(spark, f"{base}/sketches", state, k=50, fold_every=2)
    events = spark.range(12_000).select(
        F.col("id").cast("string").alias("session_id"),
        F.expr("if(id % 10 < 7, 60, cast(pow(1.0009, id) as bigint))").alias("length"),
    )

    def silver_of(part, seconds):
        timed = part.select("session_id", F.explode(F.array(F.lit(0), seconds)).alias("s"))
        return timed.select(
            "session_id", F.lit("page_view").alias("event_type"), F.lit(1.0).alias("price"),
            F.timestamp_seconds(F.lit(T0) + F.col("s")).alias("event_time"),
        )

    state.upsert(silver_of(events.where("id % 2 = 0"), F.lit(5)), 0)
    sketches.refresh(0)
    state.upsert(silver_of(events, F.col("length")), 1)
    sketches.refresh(1)
    durations = session_durations(state.current())
    found = sketches.checked(durations, at=(0.1, 0.5, 0.75, 0.9, 0.99))
    assert [r["within"] for r in found.collect()] == [True] * 5
    row = sketches.merged().first()
    assert row["sessions"] == 12_000 and len(row["sketch"]) < 8_000
    assert sketches.quantiles(version=0).first()["p99"] == 5
    sketches.table.compact(["bucket"])
    assert rows(sketches.checked(durations)) == rows(sketches.checked(durations))
    assert sketches.merged().first()["sessions"] == 12_000
    # A wrong sketch is told.
    assert not all(r["within"] for r in sketches.checked(durations, version=0).collect())


def test_arrivals_are_cut_before_records_are_made(spark):
    """Same rows as cutting the records by their time, but records of one arrival alone."""
    sf_dir = "/root/testdata/sf0.001"
    source = source_events(spark, sf_dir)
    records = faulty_records(source)
    _, found = arriving(spark, sf_dir, "cut", 3)
    for arrival, part in zip(found, parts_of(source, F.col("timestamp"), 3), strict=True):
        assert rows(arrival) == rows(records.where(part)) != []
        # The condition is below the generator that makes records.
        text = plan(arrival)
        assert "FLOOR" in text[text.rindex("Generate") :]
