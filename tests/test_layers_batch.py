import math
from random import Random

import pytest
from helpers import T0, at, event, naive, plan, record, records, rows, silver, silver_row
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sessionloom.operators.bronze import decode_records
from sessionloom.operators.enrich import enrich, text_bytes
from sessionloom.operators.funnel import funnel, session_rollup
from sessionloom.operators.gold import (
    _slot_totals,
    activity_windows,
    metric_aggregates,
    session_metrics,
)
from sessionloom.operators.reports import (
    duration_histogram,
    duration_quantiles,
    hourly_revenue,
    session_durations,
    session_spans,
    top_products,
)
from sessionloom.operators.silver import clean, dedupe, to_silver
from sessionloom.session import conf_overrides
from sessionloom.sources.broker import BROKER_SCHEMA, encode_events
from sessionloom.sources.tables import BRONZE_SCHEMA, GOLD_SCHEMA, SILVER_SCHEMA


def test_layer_schemas(spark):
    bronze = decode_records(records(spark, event()))
    assert bronze.schema.names == BRONZE_SCHEMA.names
    assert [f.dataType for f in bronze.schema] == [f.dataType for f in BRONZE_SCHEMA]
    layer = to_silver(bronze)
    assert [(f.name, f.dataType) for f in layer.schema] == [
        (f.name, f.dataType) for f in SILVER_SCHEMA
    ]
    gold = session_metrics(layer)
    assert [(f.name, f.dataType) for f in gold.schema] == [
        (f.name, f.dataType) for f in GOLD_SCHEMA
    ]


def test_encode_round_trip(spark):
    row = silver_row(1.5, id="é\"1")
    sent = encode_events(
        silver(spark, row, silver_row(None, id="n")),
        topic=F.lit("t"),
        partition=F.lit(0),
        offset=F.lit(0).cast("long"),
        timestamp=F.lit(at(0)),
        timestampType=F.lit(0),
    )
    assert sent.schema.names == BROKER_SCHEMA.names
    back = {r["event_id"]: r for r in decode_records(sent).collect()}
    assert tuple(back['é"1'])[4:] == row[:7]
    assert back["n"]["timestamp"] is None
    assert '"timestamp":null' in back["n"]["raw_value"]


def test_null_filter_reaches_the_scan(spark, base):
    decode_records(records(spark, event())).write.parquet(f"{base}/bronze")
    with conf_overrides(spark, {"spark.sql.maxMetadataStringLength": "10000"}):
        text = plan(to_silver(spark.read.schema(BRONZE_SCHEMA).parquet(f"{base}/bronze")))
    pushed = text[text.index("PushedFilters") :]
    for field in BRONZE_SCHEMA.names[4:]:
        assert f"IsNotNull({field})" in pushed
    assert "In(event_type" in pushed
    assert "raw_value" not in text[text.index("ReadSchema") :]


def test_first_arrival_wins(spark):
    sends = [
        record(event(price=3.0), partition=1, offset=0, seconds=5),
        record(event(price=1.0), partition=2, offset=9, seconds=1),
        record(event(price=2.0), partition=2, offset=10, seconds=1),
        record(event(price=None), partition=0, offset=0, seconds=0),
        record(event(event_id="e2"), partition=0, offset=1, seconds=9),
    ]
    layer = to_silver(decode_records(spark.createDataFrame(sends, BROKER_SCHEMA)))
    assert {(r["event_id"], r["price"]) for r in layer.collect()} == {("e1", 1.0), ("e2", 9.5)}


def test_copies_are_cut_before_the_shuffle(spark):
    """An id holding most rows must not travel: one row per input partition is enough."""
    hot = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 != 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
        F.lit(0).alias("kafka_partition"),
        F.col("id").alias("kafka_offset"),
        F.lit(at(0)).alias("kafka_timestamp"),
    )
    result = dedupe(hot)
    text = plan(result)
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")
    assert result.count() == 66_667 + 1
    assert result.where("event_id = 'hot'").first()["kafka_offset"] == 1


def test_unknown_dedupe_mode(spark):
    with pytest.raises(ValueError):
        dedupe(silver(spark), mode="sometimes")


def test_window_bounds_and_gross_metrics(spark):
    layer = silver(
        spark,
        silver_row(0, kind="page_view"),
        silver_row(299.999999, kind="purchase", price=9.5),
        silver_row(300, kind="add_to_cart"),
        silver_row(301, kind="remove_from_cart"),
        silver_row(10, "s2", "search", 7.0),
        silver_row(None, "s3"),
    )
    assert rows(session_metrics(layer).selectExpr("session_id", "unix_seconds(window_start)",
            "unix_seconds(window_end)", "page_views", "cart_adds", "purchases", "revenue")) == [
        ("s1", T0, T0 + 300, 1, 0, 1, 9.5),
        ("s1", T0 + 300, T0 + 600, 0, 1, 0, 0.0),
        ("s2", T0, T0 + 300, 0, 0, 0, 0.0),
    ]


def test_session_window_gap_tie(spark):
    layer = silver(spark, *[silver_row(s) for s in (0, 1800, 3600.000001)])
    got = activity_windows(layer, gap="30 minutes").orderBy("window_start").collect()
    assert [(r["window_start"], r["window_end"], r["events"]) for r in got] == [
        (naive(0), naive(3600), 2),
        (naive(3600.000001), naive(5400.000001), 1),
    ]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.sampled_from("ab"), st.integers(-8_000, 8_000), st.sampled_from([0, 1, 999_999])),
        min_size=1,
        max_size=40,
    )
)
def test_session_windows_equal_the_built_in(spark, events):
    """Slots and merge give what Spark's own session window gives, before the epoch too."""
    made = [
        silver_row(s - T0 + m / 1e6, user=u, kind="purchase", price=2.0) for u, s, m in events
    ]
    layer = silver(spark, *made)
    ours = activity_windows(layer, gap="10 minutes")
    theirs = (
        layer.groupBy(F.session_window("event_time", "10 minutes").alias("w"), "user_id")
        .agg(F.count("*").alias("events"), *metric_aggregates())
        .select("user_id", "w.start", "w.end", "events", "page_views", "cart_adds", "purchases",
                "revenue")
    )
    assert rows(ours) == rows(theirs)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-9, 60)), min_size=1, max_size=60))
def test_session_windows_over_segments(spark, events):
    """Windows that end inside, begin in, span or touch any number of segments."""
    made = [silver_row(600 * s + 300 * (s % 2), user=u, kind="purchase", price=2.0) for u, s in events]
    layer = silver(spark, *made)
    whole = rows(activity_windows(layer, gap="10 minutes", segment=10_000))
    for segment in (1, 2, 5):
        assert rows(activity_windows(layer, gap="10 minutes", segment=segment)) == whole


def test_hot_user_is_ordered_in_segments(spark):
    """A user with a third of all slots: no task orders more than a segment of them."""
    slots = 9_000
    events = spark.range(0, 3 * slots).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 1000)).alias("user_id"),
        F.lit("page_view").alias("event_type"),
        F.lit(1.0).alias("price"),
        # Every fourth slot of ten minutes without an event.
        F.timestamp_seconds(F.lit(T0) + F.expr("(id div 3) * 600 + (id div 9) * 1300")).alias("event_time"),
    )
    windows = activity_windows(events, gap="10 minutes", segment=100)
    assert windows.where("user_id = 'hot'").count() == slots / 3
    text = plan(windows)
    ordered = [line for line in text.splitlines() if "Window [lag(" in line]
    assert any("_segment" in line.split("], [")[1] for line in ordered)
    # What is ordered by user alone are the borders of segments.
    totals = _slot_totals(events, "10 minutes", "user_id").where("user_id = 'hot'")
    per_segment = totals.groupBy(F.expr("floor(_slot / 100)")).count()
    assert per_segment.agg(F.max("count")).first()[0] <= 100 and per_segment.count() > 90


def test_hot_user_is_totalled_before_it_is_ordered(spark):
    """However many events a user has, the ordering step gets a row per slot of the gap."""
    hot = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("user_id"),
        F.lit("page_view").alias("event_type"),
        F.lit(1.0).alias("price"),
        F.timestamp_seconds(F.lit(T0) + F.col("id") * 0.1).alias("event_time"),
    )
    windows = activity_windows(hot, gap="30 minutes")
    got = windows.where("user_id = 'hot'").collect()
    assert [(r["events"], r["window_end"]) for r in got] == [(20_000, naive(5999.7 + 1800))]
    slots = _slot_totals(hot, "30 minutes", "user_id").where("user_id = 'hot'")
    assert slots.count() == 4
    text = plan(windows)
    below_order = text[text.index("Sort [user_id") :]
    # By border or segment, by segment, and the totals.
    assert below_order.count("Exchange") == 3
    assert "partial_count" in below_order[below_order.rindex("Exchange") :]


def test_hot_session_is_combined_before_the_shuffle(spark):
    text = plan(session_metrics(silver(spark, silver_row(0))))
    assert text.count("Exchange") == 1
    assert "partial_sum" in text[text.index("Exchange") :]


def gold(spark, *counts):
    made = [(s, at(300 * i), at(300 * i + 300), v, c, p, 0.0) for i, (s, v, c, p) in enumerate(counts)]
    return spark.createDataFrame(made, GOLD_SCHEMA)


@pytest.mark.parametrize(
    ("counts", "expected"),
    [
        ([("s1", 1, 0, 0), ("s1", 0, 1, 0), ("s2", 0, 0, 1)], (1, 1, 1, 1.0, 1.0, 1.0)),
        ([], (0, 0, 0, 0.0, 0.0, 0.0)),
        ([("s1", 3, 0, 0), ("s2", 1, 0, 0)], (2, 0, 0, 0.0, 0.0, 0.0)),
        ([("s1", 1, 0, 0), ("s2", 0, 1, 1), ("s3", 0, 1, 0)], (1, 2, 1, 2.0, 0.5, 1.0)),
    ],
)
def test_funnel(spark, counts, expected):
    assert [tuple(r) for r in funnel(gold(spark, *counts), 7).collect()] == [(7, *expected)]


def test_rollup_spans_windows(spark):
    got = session_rollup(gold(spark, ("s1", 1, 0, 0), ("s1", 2, 1, 0), ("s2", 0, 0, 4)))
    assert rows(got) == [("s1", 3, 1, 0), ("s2", 0, 0, 4)]


def test_funnel_aggregates_before_each_shuffle(spark, base):
    gold(spark, ("s1", 1, 0, 0)).write.parquet(f"{base}/g")
    text = plan(funnel(spark.read.schema(GOLD_SCHEMA).parquet(f"{base}/g")))
    assert text.count("Exchange") == 2
    assert "partial_sum" in text[text.rindex("Exchange") :]
    assert "revenue" not in text[text.index("ReadSchema") :]


def test_reports(spark):
    layer = silver(
        spark,
        silver_row(0, "s1", "page_view"),
        silver_row(61.9, "s1", "purchase", 5.0),
        silver_row(3600, "s2", "purchase", 2.5),
        silver_row(4000, "s3", "page_view"),
        silver_row(4400, "s3", "search"),
    )
    hours = hourly_revenue(session_metrics(layer)).orderBy("hour").collect()
    assert [(r["hour"], r["revenue"], r["purchases"]) for r in hours] == [
        (naive(0), 5.0, 1),
        (naive(3600), 2.5, 1),
    ]
    assert rows(session_durations(session_spans(layer)).select("session_id", "events", "duration_s")) == [
        ("s1", 2, 61),
        ("s2", 1, 0),
        ("s3", 2, 400),
    ]
    assert rows(duration_histogram(layer)) == [(0, 2), (300, 1)]
    assert rows(duration_quantiles(layer, (0.5, 0.999))) == [
        (3, 400.0, 61.0, pytest.approx(399.322))
    ]


def test_top_products_ties(spark):
    made = [
        ("e", "u", "s", "purchase", p, v, float(T0), at(0))
        for p, v in [("b", 2.0), ("a", 1.0), ("a", 1.0), ("c", 9.0)]
    ]
    got = top_products(spark.createDataFrame(made, SILVER_SCHEMA), 2)
    assert [tuple(r) for r in got.collect()] == [("c", 9.0, 1), ("a", 2.0, 2)]
    assert "TakeOrderedAndProject" in plan(got)


def test_enrich_both_ways(spark):
    layer = silver(spark, silver_row(0), silver_row(1, id="e2")).withColumn(
        "product_id", F.when(F.col("event_id") == "e2", "none").otherwise(F.col("product_id"))
    )
    catalog = spark.createDataFrame([("prod_1", "Lamp"), ("prod_2", "Desk")], "product_id string, name string")
    small = enrich(layer, catalog)
    large = enrich(layer, catalog, broadcast_bytes=0)
    assert rows(small) == rows(large)
    assert {(r["event_id"], r["name"]) for r in large.collect()} == {("e1", "Lamp"), ("e2", None)}
    assert "BroadcastHashJoin" in plan(small)
    assert "SortMergeJoin" in plan(large)
    assert text_bytes(catalog) == len('{"product_id":"prod_1","name":"Lamp"}') * 2
    assert text_bytes(catalog.limit(0)) == 0


def test_hot_product_is_spread(spark, base):
    """The events of the hot product are split over several tasks, those of others are not."""
    hot = spark.range(0, 60_000, 1, 8).select(
        F.uuid().alias("event_id"),
        F.when(F.col("id") % 3 > 0, "prod_1").otherwise(F.concat(F.lit("prod_"), "id")).alias("product_id"),
    )
    catalog = spark.createDataFrame([("prod_1", "Lamp")], "product_id string, name string")
    sizes = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    with conf_overrides(spark, sizes):
        enrich(hot, catalog, broadcast_bytes=0).write.parquet(f"{base}/joined")
    lamps = spark.read.parquet(f"{base}/joined").where("name = 'Lamp'")
    per_task = [r["count"] for r in lamps.groupBy(F.input_file_name()).count().collect()]
    assert sum(per_task) == 40_000 and max(per_task) < 20_000


def test_quantiles_meet_a_plain_sort(spark):
    random = Random(3)
    seconds = [random.choice([random.randint(0, 50), random.randint(0, 400_000)]) for _ in range(60)]
    layer = silver(
        spark, *[silver_row(t, f"s{i}") for i, s in enumerate(seconds) for t in (0, s)]
    )
    at = (0.0, 0.25, 0.5, 0.9, 1.0)
    found = duration_quantiles(layer, at).first()
    ordered = sorted(seconds)
    for q in at:
        rank = q * (len(ordered) - 1)
        low, high = ordered[math.floor(rank)], ordered[math.ceil(rank)]
        assert found[f"p{q * 100:g}"] == pytest.approx(low + (high - low) * (rank % 1))
    empty = duration_quantiles(layer.limit(0)).first()
    assert empty["sessions"] is None or empty["sessions"] == 0


def test_infinite_price_survives(spark):
    df = decode_records(records(spark, '{"event_id":"i","user_id":"u","session_id":"s",'
        '"event_type":"purchase","product_id":"p","price":Infinity,"timestamp":0}'))  # fmt: skip
    assert clean(df).first()["price"] == math.inf
