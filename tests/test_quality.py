from helpers import event, plan, record, rows, silver, silver_row
from pyspark.sql import functions as F

from sessionloom.operators.bronze import decode_records
from sessionloom.operators.gold import session_metrics
from sessionloom.operators.quality import (
    changed_rows,
    compare_tables,
    gold_reconcile,
    layer_counts,
    lost_events,
    missing_values,
    offset_audit,
    offset_gaps,
    row_differences,
    table_digests,
)
from sessionloom.operators.silver import to_silver
from sessionloom.sources.broker import BROKER_SCHEMA


def bronze(spark, *sends):
    return decode_records(spark.createDataFrame(list(sends), BROKER_SCHEMA))


def test_offsets(spark):
    df = bronze(spark, *[record(event(), p, o) for p, o in [(0, 5), (0, 6), (0, 8), (0, 8), (1, 0)]])
    assert rows(offset_audit(df)) == [(0, 4, 3, 5, 8, 1, 1), (1, 1, 1, 0, 0, 0, 0)]


def test_offset_audit_spreads_a_single_partition(spark):
    df = bronze(spark, record(event()))
    text = plan(offset_audit(df))
    assert "hashpartitioning(kafka_partition" in text
    inner = text[text.rindex("hashpartitioning") :]
    assert inner.startswith("hashpartitioning(kafka_partition") and "kafka_offset" in inner[:80]


def test_offset_gaps(spark):
    """Gaps inside a stretch, across one border and across empty stretches; repeats."""
    places = [(0, o) for o in [-3, 0, 1, 1, 4, 7, 8, 40, 40, 40]] + [(1, 5)]
    df = spark.createDataFrame(places, "kafka_partition int, kafka_offset long")
    wanted = [
        ("missing", 0, -2, -1, 0),
        ("missing", 0, 2, 3, 0),
        ("missing", 0, 5, 6, 0),
        ("missing", 0, 9, 39, 0),
        ("repeated", 0, 1, 1, 2),
        ("repeated", 0, 40, 40, 3),
    ]
    for span in (1, 2, 8, 1000):
        assert rows(offset_gaps(df, span)) == sorted(wanted, key=repr)
    assert offset_gaps(df.limit(0)).count() == 0


def test_offset_gaps_of_one_huge_partition(spark):
    """Its offsets spread over tasks; one task sees a row per stretch at most."""
    df = spark.range(200_000).select(F.lit(0).alias("kafka_partition"), F.col("id").alias("kafka_offset"))
    df = df.where("kafka_offset % 50000 <> 7")
    found = offset_gaps(df, 1000)
    assert sorted(r[2] for r in rows(found)) == [7, 50_007, 100_007, 150_007]
    text = plan(found)
    windows = [line for line in text.splitlines() if "Window [lead(kafka_offset" in line]
    assert windows and all("_stretch" in line.split("],", 1)[1] for line in windows)


def test_row_differences_count_copies(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    right = spark.createDataFrame([("x", 2), (None, 1), ("y", 3)], "b string, a int")
    assert rows(row_differences(left, right)) == [(1, None, 1), (3, "y", -1)]
    assert rows(compare_tables(left, right)) == [(3, 3, 1, 1)]
    assert rows(compare_tables(left.limit(0), right.limit(0))) == [(0, 0, 0, 0)]
    assert rows(compare_tables(left, right.limit(0))) == [(3, 0, 3, 0)]
    assert rows(changed_rows(left, right)) == [(1, None, 1), (3, "y", -1)]


def test_equal_tables_are_compared_by_digests_alone(spark, base):
    left = spark.range(20_000).selectExpr("id", "if(id % 7 = 0, null, cast(id as string)) as t")
    left.write.parquet(f"{base}/left")
    left.repartition(7).write.parquet(f"{base}/right")
    left, right = (spark.read.parquet(f"{base}/{name}") for name in ("left", "right"))
    same = compare_tables(left, right)
    assert rows(same) == [(20_000, 20_000, 0, 0)]
    assert rows(changed_rows(left, right)) == []
    # Digests are combined before they move.
    digests = table_digests(left)
    assert "partial_count" in plan(digests).split("Exchange")[1]
    # One changed row opens one bucket on each side at most, copies told apart by how often.
    changed = right.unionByName(right.where("id = 77")).withColumn(
        "t", F.expr("if(id = 5, 'x', t)")
    )
    ours = {r["_bucket"]: r["_digest"] for r in digests.collect()}
    theirs = {r["_bucket"]: r["_digest"] for r in table_digests(changed).collect()}
    assert 2 <= sum(ours.get(b) != theirs.get(b) for b in ours | theirs) <= 3
    assert rows(compare_tables(left, changed)) == [(20_000, 20_001, 1, 2)]
    assert rows(changed_rows(left, changed)) == sorted([(5, "5", 1), (5, "x", -1), (77, None, -1)], key=repr)


def test_missing_values(spark):
    df = bronze(spark, record(event()), record(event(price="NaN")), record("broken"))
    got = missing_values(df).first().asDict()
    assert (got["rows"], got["no_price"], got["no_event_id"]) == (3, 2, 1)


def test_gold_reconcile_finds_each_kind_of_difference(spark):
    layer = silver(
        spark,
        silver_row(0, "ok", "purchase", 0.1),
        silver_row(400, "ok", "purchase", 0.2),
        silver_row(0, "count"),
        silver_row(0, "money", "purchase", 5.0),
        silver_row(0, "absent"),
    )
    metrics = session_metrics(layer)
    assert gold_reconcile(layer, metrics).count() == 0
    off = (
        metrics.where("session_id <> 'absent'")
        .withColumn("page_views", F.expr("page_views + int(session_id = 'count')"))
        .withColumn("revenue", F.expr("revenue + int(session_id = 'money') * 0.01"))
    )
    extra = off.limit(1).withColumn("session_id", F.lit("extra"))
    found = gold_reconcile(layer, off.unionByName(extra))
    assert rows(found.select("session_id")) == [("absent",), ("count",), ("extra",), ("money",)]


def test_layer_counts(spark):
    df = bronze(
        spark,
        record(event(0), offset=0),
        record(event(0), offset=1),
        record(event(0, event_id="e2", event_type="search"), offset=2),
        record(event(0, event_type="error"), offset=3),
        record("broken", offset=4),
        record(event(900, event_id="e3"), offset=5),
    )
    layer = to_silver(df)
    metrics = session_metrics(layer)
    closed = metrics.orderBy("window_start").limit(1)
    got = dict(rows(layer_counts(df, layer, closed)))
    assert [v for _, v in sorted(got.items())] == [6, 1, 1, 1, 0, 3, 1, 1]
    nothing = layer_counts(df.limit(0), layer.limit(0), metrics.limit(0))
    assert {v for _, v in rows(nothing)} == {0}


def test_lost_events_join_one_row_per_id(spark):
    df = bronze(spark, *[record(event(0), offset=i) for i in range(50)],
                record(event(10, event_id="e2"), offset=99))
    layer = to_silver(df).where("event_id = 'e2'")
    result = lost_events(df, layer)
    assert rows(result.select("event_id", "copies", "behind_s")) == [("e1", 50, 10)]
    assert "CartesianProduct" not in plan(result) and "NestedLoop" not in plan(result)
