import json

from helpers import event, land, record

from sessionloom.__main__ import JOBS, parse
from sessionloom.sources.broker import BROKER_SCHEMA
from sessionloom.sources.tables import Layout
from sessionloom.streaming.publish import read_published


def test_jobs_from_the_command_line(spark, base, capsys):
    def job(name, *more):
        args = parse([name, "--base", base, "--once", "--state-partitions", "2", *more])
        JOBS[name](spark, args)
        return capsys.readouterr().out

    job("round-trip")
    assert job("funnel").splitlines()[1] == "viewed_sessions=0"

    sends = [event(0), event(1, event_id="e2", event_type="add_to_cart"), event(900, event_id="e3")]
    made = [record(e, 0, i, i) for i, e in enumerate(sends)]
    land(spark.createDataFrame(made, BROKER_SCHEMA), f"{base}/in")
    job("bronze", "--records", f"{base}/in")
    job("silver")
    job("gold")
    lines = dict(line.split("=") for line in job("funnel").splitlines())
    assert int(lines["gold_version"]) >= 0
    assert lines["viewed_sessions"] == lines["carted_sessions"] == "1"
    assert lines["view_to_cart_rate"] == "1.0"

    with open(f"{base}/events.json", "w") as out:
        out.write(json.dumps(event()) + "\n" + json.dumps(event(price=None)) + "\nbroken\n")
    assert job("publish", "--input", f"{base}/events.json") .startswith("1 accepted, 2 in quarantine")


def test_jobs_over_the_layers(spark, base, capsys):
    def job(name, *more):
        args = parse([name, "--base", base, "--once", "--state-partitions", "2", *more])
        JOBS[name](spark, args)
        return capsys.readouterr().out

    sends = [event(i, event_id=f"e{i}", event_type="purchase") for i in range(3)]
    made = [record(e, 0, i, i) for i, e in enumerate([*sends, sends[0], "broken"])]
    land(spark.createDataFrame(made, BROKER_SCHEMA), f"{base}/in")
    job("bronze", "--records", f"{base}/in")
    for layer in ("silver", "gold", "sessions", "refresh"):
        job(layer)
    catalog = spark.createDataFrame([("prod_1", "Lamp")], "product_id string, name string")
    catalog.write.parquet(f"{base}/catalog")
    job("enrich", "--catalog", f"{base}/catalog")
    joined = spark.read.parquet(f"{base}/tables/enriched/batches")
    assert [r["name"] for r in joined.collect()] == ["Lamp"] * 3

    assert job("report", "--report", "top-products").endswith("1 row(s)\n")
    assert job("report", "--report", "durations", "--since", "2024-01-02").endswith("0 row(s)\n")
    for name in ("hourly-revenue", "duration-histogram", "duration-quantiles", "activity-windows"):
        job("report", "--report", name)
    assert job("compact") == "0 date(s) of silver, 0 block(s) of gold\n"
    account = dict(line.split("=") for line in job("audit").splitlines())
    assert (account["1_bronze"], account["4_repeated"], account["6_silver"]) == ("5", "1", "3")
    offsets = spark.read.parquet(f"{base}/tables/audit/offsets").first()
    assert offsets["records"] == 5 and offsets["missing"] == 0
    assert spark.read.parquet(f"{base}/tables/audit/gaps").count() == 0
    kept = spark.read.parquet(f"{base}/tables/session_reports/histogram/batches")
    assert [(r["bucket_start_s"], r["sessions"]) for r in kept.collect()] == [(0, 1)]

    job("publish", "--records", f"{base}/in")
    published = read_published(spark, Layout(base))
    assert published.where("accepted").count() == 4 and published.count() == 5
