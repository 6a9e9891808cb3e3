"""Jobs from the command line: ``python -m sessionloom <job> --base <dir>``."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.operators import quality, reports
from sessionloom.operators.enrich import enrich, enrich_batches
from sessionloom.operators.funnel import funnel
from sessionloom.operators.gold import activity_windows
from sessionloom.session import build_session
from sessionloom.sources.batches import BatchTable
from sessionloom.sources.broker import (
    MAX_FILE_AGE,
    publish_kafka,
    stream_kafka,
    stream_record_files,
)
from sessionloom.sources.delta import DeltaTableStore
from sessionloom.sources.tables import (
    BRONZE_SCHEMA,
    GOLD_SCHEMA,
    SILVER_SCHEMA,
    Layout,
    compact_silver,
    read_layer,
    read_table,
    replace_table,
)
from sessionloom.streaming.layers import (
    ONCE,
    gold_table,
    start,
    start_bronze,
    start_gold,
    start_silver,
    stream_layer,
)
from sessionloom.streaming.publish import publish_checked, start_publish
from sessionloom.streaming.progress import ProgressLog
from sessionloom.streaming.refresh import (
    FUNNEL,
    HISTOGRAM,
    HOURLY_REVENUE,
    TOP_PRODUCTS,
    start_refresh,
    start_session_reports,
)
from sessionloom.streaming.sessions import start_session_state


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="sessionloom", description=__doc__)
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--base", required=True, help="directory of tables and checkpoints")
    parser.add_argument("--format", default="parquet", choices=["parquet", "delta"])
    parser.add_argument("--package", action="append", default=[], help="Maven coordinate")
    parser.add_argument("--records", help="directory of record files, instead of Kafka")
    parser.add_argument("--servers", default="localhost:9092")
    parser.add_argument("--topic")
    parser.add_argument("--input", help="JSON lines to publish")
    parser.add_argument("--catalog", help="product table (Parquet) to enrich events with")
    parser.add_argument("--report", choices=sorted(REPORTS))
    parser.add_argument("--since", type=_instant, help="UTC, such as 2024-01-31T12:00")
    parser.add_argument("--until", type=_instant, help="UTC, not included")
    parser.add_argument("--interval", help='time between batches, such as "1 minute"')
    parser.add_argument("--once", action="store_true", help="take in what is there, then end")
    parser.add_argument("--state-partitions", type=int)
    parser.add_argument("--max-per-trigger", type=int, help="offsets, or files, per batch")
    parser.add_argument(
        "--max-file-age", default=MAX_FILE_AGE, help="files older than the newest by this are not taken in"
    )
    parser.add_argument(
        "--extra", action="append", default=[], help="field the contract has gained, as name:type"
    )
    args = parser.parse_args(argv)
    if args.job == "bronze" and not (args.records or args.topic):
        parser.error("bronze reads --records or --topic")
    if args.job == "publish" and not (args.input or args.records):
        parser.error("publish reads --input, or --records as a stream")
    if args.job == "enrich" and not args.catalog:
        parser.error("enrich reads --catalog")
    if args.job == "report" and not args.report:
        parser.error("report needs --report")
    return args


def _extra(args: argparse.Namespace) -> list[T.StructField]:
    return [f for text in args.extra for f in T.StructType.fromDDL(text.replace(":", " ", 1)).fields]


def _instant(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def _run(args: argparse.Namespace) -> dict:
    trigger = ONCE if args.once else {"processingTime": args.interval} if args.interval else None
    return {
        "trigger": trigger,
        "fmt": args.format,
        "state_partitions": args.state_partitions,
        "name": args.job,
    }


def bronze(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.records:
        records = stream_record_files(spark, args.records, args.max_per_trigger)
    else:
        records = stream_kafka(
            spark, args.servers, args.topic, max_offsets_per_trigger=args.max_per_trigger
        )
    start_bronze(records, Layout(args.base), extra=_extra(args), **_run(args)).awaitTermination()


def silver(spark: SparkSession, args: argparse.Namespace) -> None:
    start_silver(
        spark,
        Layout(args.base),
        max_files_per_trigger=args.max_per_trigger,
        extra=_extra(args),
        max_file_age=args.max_file_age,
        **_run(args),
    ).awaitTermination()


def gold(spark: SparkSession, args: argparse.Namespace) -> None:
    start_gold(
        spark,
        Layout(args.base),
        max_files_per_trigger=args.max_per_trigger,
        max_file_age=args.max_file_age,
        **_run(args),
    ).awaitTermination()


def funnel_report(spark: SparkSession, args: argparse.Namespace) -> None:
    """The funnel of gold's newest version, one ``key=value`` line per field."""
    layout = Layout(args.base)
    if args.format == "delta":
        table = DeltaTableStore(spark, layout.table("gold"), GOLD_SCHEMA)
    else:
        table = gold_table(spark, layout)
    version = table.latest_version()
    for key, value in funnel(table.snapshot(version), version).first().asDict().items():
        print(f"{key}={value}")


def round_trip(spark: SparkSession, args: argparse.Namespace) -> None:
    """Write a row and read it back, to see that the session can use its table format."""
    path = f"{args.base}/round_trip"
    row = spark.createDataFrame([(1, "hello table")], "id long, message string")
    replace_table(row, path, args.format)
    counts = quality.compare_tables(row, read_table(spark, path, row.schema, args.format)).first()
    if counts["only_left"] or counts["only_right"]:
        raise SystemExit(f"{path} does not hold what was written to it: {counts.asDict()}")
    print(f"{path}: wrote {counts['rows_left']}, read back {counts['rows_right']}, all equal")


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    """Check JSON events against the contract; the good ones go to the topic, if one is named.
    Lines of a file in one go, or record files as a stream."""
    if args.records:
        records = stream_record_files(spark, args.records, args.max_per_trigger)
        raw = records.select(F.col("value").cast("string").alias("raw_value"))
        layout, run = Layout(args.base), _run(args)
        start_publish(raw, layout, args.servers, args.topic, **run).awaitTermination()
        return
    out = f"{args.base}/published"
    publish_checked(spark.read.text(args.input).withColumnRenamed("value", "raw_value"), out)
    written = spark.read.schema("key binary, value binary, accepted boolean").parquet(out)
    counts = {r["accepted"]: r["count"] for r in written.groupBy("accepted").count().collect()}
    if args.topic:
        publish_kafka(written.where("accepted").select("key", "value"), args.servers, args.topic)
    print(f"{counts.get(True, 0)} accepted, {counts.get(False, 0)} in quarantine ({out})")


def sessions(spark: SparkSession, args: argparse.Namespace) -> None:
    """Keep the session table."""
    _, query = start_session_state(
        spark, Layout(args.base), max_files_per_trigger=args.max_per_trigger, **_run(args)
    )
    query.awaitTermination()


KEPT = {"top_products": TOP_PRODUCTS, "hourly": HOURLY_REVENUE}
SESSION_REPORTS = {"histogram": HISTOGRAM, "funnel": FUNNEL}


def refresh(spark: SparkSession, args: argparse.Namespace) -> None:
    """Keep the reports that can be kept from new rows alone, and those that follow sessions."""
    layout = Layout(args.base)
    run = {key: value for key, value in _run(args).items() if key != "name"}
    queries = []
    for name, report in KEPT.items():
        silver_rows = stream_layer(
            spark, layout, "silver", SILVER_SCHEMA, args.format, args.max_per_trigger
        )
        queries.append(start_refresh(spark, silver_rows, name, report, layout, **run)[1])
    if args.format == "parquet":
        queries.append(
            start_session_reports(
                spark, layout, SESSION_REPORTS, max_files_per_trigger=args.max_per_trigger, **run
            )[1]
        )
    for query in queries:
        query.awaitTermination()


def enriched(spark: SparkSession, args: argparse.Namespace) -> None:
    """Join silver to a product table, batch by batch."""
    layout = Layout(args.base)

    def catalog() -> DataFrame:
        return spark.read.parquet(args.catalog)

    rows = enrich(spark.createDataFrame([], SILVER_SCHEMA), catalog())
    checkpoint = layout.checkpoint("enriched")
    table = BatchTable(spark, layout.table("enriched"), rows.schema, checkpoint).create()
    silver_rows = stream_layer(
        spark, layout, "silver", SILVER_SCHEMA, args.format, args.max_per_trigger
    )
    each = enrich_batches(catalog, table.write)
    start(silver_rows, checkpoint, each_batch=each, **_run(args)).awaitTermination()


# Report name -> layer it reads, and how it is made.
REPORTS = {
    "hourly-revenue": ("gold", reports.hourly_revenue),
    "top-products": ("silver", reports.top_products),
    "durations": ("silver", lambda rows: reports.session_durations(reports.session_spans(rows))),
    "duration-histogram": ("silver", reports.duration_histogram),
    "duration-quantiles": ("silver", reports.duration_quantiles),
    "activity-windows": ("silver", activity_windows),
}


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    """Make a report of a time range and store it as a table."""
    layout = Layout(args.base)
    layer, make = REPORTS[args.report]
    if layer == "gold":
        rows = gold_table(spark, layout).snapshot(None, args.since, args.until)
    else:
        rows = read_layer(
            spark, layout, layer, SILVER_SCHEMA, args.since, args.until, args.format
        )
    path = layout.table(f"made/{args.report}")
    replace_table(make(rows), path)
    print(f"{path}: {read_table(spark, path).count()} row(s)")


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Rewrite what is closed: dates of silver, blocks of gold batches."""
    layout = Layout(args.base)
    dates = compact_silver(spark, layout, extra=_extra(args))
    folds = gold_table(spark, layout).compact(["session_id", "window_start"])
    print(f"{dates} date(s) of silver, {len(folds)} block(s) of gold")
    for fold in folds:
        print(
            f"level {fold.level}, block {fold.number}: {fold.files_before} file(s), {fold.bytes_before} bytes "
            f"-> {fold.files_after} file(s), {fold.bytes_after} bytes"
        )


def audit(spark: SparkSession, args: argparse.Namespace) -> None:
    """Reconcile the layers, one ``key=value`` line per step; the full audits become tables."""
    layout = Layout(args.base)
    raw = read_layer(spark, layout, "bronze", BRONZE_SCHEMA, fmt=args.format)
    clean = read_layer(spark, layout, "silver", SILVER_SCHEMA, fmt=args.format)
    metrics = gold_table(spark, layout).snapshot()
    audits = {
        "offsets": quality.offset_audit(raw),
        "missing": quality.silver_audit(raw, clean),
        "lost": quality.lost_events(raw, clean),
        "gaps": quality.offset_gaps(raw),
    }
    for name, rows in audits.items():
        replace_table(rows, layout.table(f"audit/{name}"))
    for step in quality.layer_counts(raw, clean, metrics).collect():
        print(f"{step['step']}={step['rows']}")


JOBS = {
    "bronze": bronze,
    "silver": silver,
    "gold": gold,
    "funnel": funnel_report,
    "round-trip": round_trip,
    "publish": publish,
    "sessions": sessions,
    "refresh": refresh,
    "enrich": enriched,
    "report": report,
    "compact": compact,
    "audit": audit,
}


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session(f"sessionloom-{args.job}", args.package)
    spark.sparkContext.setLogLevel("WARN")
    if args.job in ("bronze", "silver", "gold"):
        # What the engine says of each batch goes to a table beside the layers.
        with ProgressLog(spark, Layout(args.base)):
            JOBS[args.job](spark, args)
    else:
        JOBS[args.job](spark, args)


if __name__ == "__main__":
    main()
