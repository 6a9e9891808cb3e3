"""Reports kept current by a stream, from the new rows of each batch alone."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sessionloom.functions.scalar import event_clock
from sessionloom.operators.funnel import STAGES, funnel_of_counts
from sessionloom.operators.reports import (
    duration_bucket,
    duration_buckets,
    exact_quantiles,
    purchase_totals,
    session_durations,
    session_spans,
    top_of,
)
from sessionloom.sources.batches import FOLD_EVERY, BatchTable
from sessionloom.sources.tables import SILVER_SCHEMA, Layout
from sessionloom.streaming.layers import start, stream_layer
from sessionloom.streaming.sessions import BUCKETS, STATE_SCHEMA, SessionState

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Report:
    """``partial``: what one batch of source rows adds; ``summed``: partial rows of several
    batches folded, by key; ``shown``: the report, made from folded rows."""

    partial: Step
    summed: Step
    shown: Step


def _spans_folded(rows: DataFrame) -> DataFrame:
    return rows.groupBy("session_id").agg(
        F.min("first_event").alias("first_event"),
        F.max("last_event").alias("last_event"),
        F.sum("events").alias("events"),
    )


def _purchases_folded(rows: DataFrame) -> DataFrame:
    return rows.groupBy("product_id").agg(
        F.sum("revenue").alias("revenue"), F.sum("purchases").alias("purchases")
    )


def _hours_of(silver: DataFrame) -> DataFrame:
    """Revenue and purchases per hour of the event. Windows of gold do not cross hours."""
    timed = silver.where("event_time is not null")
    hour = F.date_trunc("hour", event_clock()).alias("hour")
    paid = F.col("event_type") == "purchase"
    return timed.groupBy(hour).agg(
        F.count_if(paid).alias("purchases"),
        F.sum(F.when(paid, F.col("price")).otherwise(0.0)).alias("revenue"),
    )


def _hours_folded(rows: DataFrame) -> DataFrame:
    return rows.groupBy("hour").agg(
        F.sum("purchases").alias("purchases"), F.sum("revenue").alias("revenue")
    )


# Reports over silver that can be kept this way.
HOURLY_REVENUE = Report(_hours_of, _hours_folded, lambda rows: rows.select("hour", "revenue", "purchases"))
DURATIONS = Report(session_spans, _spans_folded, duration_buckets)
TOP_PRODUCTS = Report(purchase_totals, _purchases_folded, top_of)


class ReportTable:
    """Partial rows of a report by batch, and the report they make."""

    def __init__(
        self,
        spark: SparkSession,
        layout: Layout,
        name: str,
        report: Report,
        schema: T.StructType,
        fold_every: int = FOLD_EVERY,
    ):
        self.report = report
        self.table = BatchTable(
            spark,
            layout.table(f"report_{name}"),
            schema,
            layout.checkpoint(f"report_{name}"),
            summed=report.summed,
            fold_every=fold_every,
        )
        self.table.create()

    def refresh(self, batch: DataFrame, batch_id: int) -> None:
        """Take in the rows of one batch. A retry replaces what it wrote."""
        self.table.write(self.report.partial(batch), batch_id)

    def shown(self, version: int | None = None) -> DataFrame:
        return self.report.shown(self.report.summed(self.table.snapshot(version)))


def start_refresh(
    spark: SparkSession,
    changes: DataFrame,
    name: str,
    report: Report,
    layout: Layout,
    fold_every: int = FOLD_EVERY,
    **run,
) -> tuple[ReportTable, StreamingQuery]:
    """Keep a report over a stream of rows. ``trigger={"processingTime": "1 minute"}`` sets the
    interval."""
    schema = report.partial(spark.createDataFrame([], changes.schema)).schema
    table = ReportTable(spark, layout, name, report, schema, fold_every)
    checkpoint = layout.checkpoint(f"report_{name}")
    return table, start(changes, checkpoint, each_batch=table.refresh, **run)


# -- Reports of sessions ---------------------------------------------------------------------


@dataclass(frozen=True)
class SessionReport:
    """Counts of sessions by some property of theirs. ``property``: columns made of a session
    row; ``shown``: the report, made of rows (property, sessions)."""

    property: Callable[[], list[Column]]
    shown: Step

    def signed(self, changes: DataFrame) -> DataFrame:
        """What a batch changes: a session that was there before is taken from the count it was
        in and added to the one it is in now. Counts that stay are left out."""
        sides = [
            changes.where(f"{side} is not null")
            .select(f"{side}.*")
            .select(*self.property(), F.lit(sign).cast("long").alias("sessions"))
            for side, sign in (("before", -1), ("after", 1))
        ]
        return self.folded(sides[0].unionByName(sides[1]))

    def folded(self, rows: DataFrame) -> DataFrame:
        keys = [name for name in rows.columns if name != "sessions"]
        return rows.groupBy(*keys).agg(F.sum("sessions").alias("sessions")).where("sessions <> 0")


def _stages() -> list[Column]:
    return [(F.col(count) > 0).alias(stage) for stage, count in STAGES.items()]


def _funnel_shown(rows: DataFrame) -> DataFrame:
    counts = [F.sum(F.when(F.col(s), F.col("sessions")).otherwise(0)) for s in STAGES]
    named = [F.coalesce(c, F.lit(0)).alias(s) for c, s in zip(counts, STAGES, strict=True)]
    return funnel_of_counts(rows.agg(*named))


HISTOGRAM = SessionReport(lambda: [duration_bucket()], lambda rows: rows)
FUNNEL = SessionReport(_stages, _funnel_shown)


# Size of a quantile sketch.
SKETCH_K = 800


class DurationSketches:
    """Quantiles of the session durations from one KLL sketch per bucket of the session table. A
    batch sketches the buckets it has rewritten anew, so nothing has to be taken out of a sketch;
    a read merges the sketches that the versions of a batch name."""

    SCHEMA = T.StructType(
        [
            T.StructField("bucket", T.LongType()),
            T.StructField("version", T.LongType()),
            T.StructField("sessions", T.LongType()),
            T.StructField("longest", T.LongType()),
            T.StructField("sketch", T.BinaryType()),
        ]
    )

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        state: SessionState,
        checkpoint: str | None = None,
        k: int = SKETCH_K,
        fold_every: int = FOLD_EVERY,
    ):
        self.state = state
        self.k = k
        self.table = BatchTable(
            spark, path, self.SCHEMA, checkpoint, summed=_newest_of_bucket, fold_every=fold_every
        )
        self.table.create()

    @property
    def rank_error(self) -> float:
        """Bound of the error of a rank, as a share of all sessions: twice the 99 % bound that is
        published for sketches of this size."""
        return 2 * 2.296 / self.k**0.9723

    def refresh(self, batch_id: int) -> None:
        rows = session_durations(self.state.touched(batch_id)).where("duration_s is not null")
        made = rows.groupBy("bucket", "version").agg(
            F.count("*").alias("sessions"),
            F.max("duration_s").alias("longest"),
            F.kll_sketch_agg_bigint("duration_s", self.k).alias("sketch"),
        )
        self.table.write(made, batch_id)

    def merged(self, version: int | None = None) -> DataFrame:
        """One row: sessions, longest, sketch of all sessions as of a batch."""
        current = [(b, v) for b, v in enumerate(self.state.versions(version)[1]) if v >= 0]
        wanted = self.table.spark.createDataFrame(current, "bucket long, version long")
        rows = self.table.snapshot(version).join(wanted, ["bucket", "version"])
        return rows.agg(
            F.sum("sessions").alias("sessions"),
            F.max("longest").cast("double").alias("longest"),
            F.kll_merge_agg_bigint("sketch", self.k).alias("sketch"),
        )

    def quantiles(
        self, at: tuple[float, ...] = (0.5, 0.9, 0.99), version: int | None = None
    ) -> DataFrame:
        """One row, as the exact form has it; values are durations that occur."""
        found = [
            F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)).alias(f"p{q * 100:g}") for q in at
        ]
        return self.merged(version).select("sessions", "longest", *found)

    def checked(
        self,
        durations: DataFrame,
        at: tuple[float, ...] = (0.5, 0.9, 0.99),
        version: int | None = None,
    ) -> DataFrame:
        """(quantile, exact, within) per quantile, held against the durations themselves: the exact
        value, and whether the sketch's value has the quantile among its true ranks (its own and
        those of its equals), up to ``rank_error``."""
        found = self.quantiles(at, version).select(F.array(*[f"p{q * 100:g}" for q in at])).scalar()
        known = durations.where("duration_s is not null").select("duration_s", found.alias("found"))
        ranks = [F.count("*").alias("n")]
        for i in range(len(at)):
            ranks.append(F.count_if(F.col("duration_s") < F.col("found")[i]).alias(f"below_{i}"))
            ranks.append(F.count_if(F.col("duration_s") <= F.col("found")[i]).alias(f"upto_{i}"))
        # One subquery for all.
        names = [f"p{q * 100:g}" for q in at]
        exact = exact_quantiles(durations, at).select(F.array(*names).alias("exact")).scalar()
        rows = []
        for i, q in enumerate(at):
            room, rank = self.rank_error * F.col("n"), F.col("n") * q
            within = rank.between(F.col(f"below_{i}") - room, F.col(f"upto_{i}") + room)
            rows.append(F.struct(F.lit(q).alias("quantile"), exact[i].alias("exact"), within.alias("within")))
        return known.agg(*ranks).select(F.inline(F.array(*rows)))


def _newest_of_bucket(rows: DataFrame) -> DataFrame:
    names = [n for n in DurationSketches.SCHEMA.fieldNames() if n != "bucket"]
    newest = rows.groupBy("bucket").agg(F.max_by(F.struct(*names), "version").alias("newest"))
    return newest.select("bucket", "newest.*")


class SessionReports:
    """The session table, reports of it and sketches of its durations, all kept by one stream: a
    batch changes the table, then each report by the sessions that changed, and by them alone. The changes of a batch are
    told by the table's versions, so a retry writes the same."""

    def __init__(
        self,
        spark: SparkSession,
        layout: Layout,
        reports: dict[str, SessionReport],
        buckets: int = BUCKETS,
        fold_every: int = FOLD_EVERY,
    ):
        # Of its own: a table that another stream also changed would take events in twice.
        self.state = SessionState(spark, layout.table("session_reports/sessions"), buckets)
        self.reports = reports
        self.tables: dict[str, BatchTable] = {}
        none = T.StructType(
            [T.StructField(side, STATE_SCHEMA) for side in ("before", "after")]
        )
        for name, report in reports.items():
            schema = report.signed(spark.createDataFrame([], none)).schema
            path = layout.table(f"session_reports/{name}")
            # A report is complete where the session stream has committed.
            checkpoint = layout.checkpoint("session_reports")
            table = BatchTable(
                spark, path, schema, checkpoint, summed=report.folded, fold_every=fold_every
            )
            self.tables[name] = table.create()
        self.sketches = DurationSketches(
            spark,
            layout.table("session_reports/sketches"),
            self.state,
            layout.checkpoint("session_reports"),
            fold_every=fold_every,
        )

    def refresh(self, batch: DataFrame, batch_id: int) -> None:
        self.state.upsert(batch, batch_id)
        self.sketches.refresh(batch_id)
        changes = self.state.changes(batch_id).persist()
        try:
            for name, table in self.tables.items():
                table.write(self.reports[name].signed(changes), batch_id)
        finally:
            changes.unpersist()

    def shown(self, name: str, version: int | None = None) -> DataFrame:
        report = self.reports[name]
        return report.shown(report.folded(self.tables[name].snapshot(version)))


def start_session_reports(
    spark: SparkSession,
    layout: Layout,
    reports: dict[str, SessionReport],
    buckets: int = BUCKETS,
    fold_every: int = FOLD_EVERY,
    max_files_per_trigger: int | None = None,
    **run,
) -> tuple[SessionReports, StreamingQuery]:
    """Silver into a session table and reports of it."""
    kept = SessionReports(spark, layout, reports, buckets, fold_every)
    silver = stream_layer(spark, layout, "silver", SILVER_SCHEMA, "parquet", max_files_per_trigger)
    checkpoint = layout.checkpoint("session_reports")
    return kept, start(silver, checkpoint, each_batch=kept.refresh, **run)
