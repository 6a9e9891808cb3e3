"""Layer tables: where they live and how they are read and written."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.functions.contract import event_schema
from sessionloom.functions.scalar import utc_date
from sessionloom.sources.batches import DATE, cluster, in_range
from sessionloom.sources.broker import MAX_FILE_AGE
from sessionloom.sources.files import qualified, read_if_there, stored_size

BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("kafka_timestamp", T.TimestampType()),
        T.StructField("raw_value", T.StringType()),
        *event_schema(strict=False).fields,
    ]
)


def bronze_schema(extra: list[T.StructField] | None = None) -> T.StructType:
    """Columns of bronze under a contract that has gained fields."""
    return T.StructType([*BRONZE_SCHEMA.fields, *(extra or [])])


def silver_schema(extra: list[T.StructField] | None = None) -> T.StructType:
    """Columns of silver under a contract that has gained fields; rows from before have none."""
    time = T.StructField("event_time", T.TimestampType())
    return T.StructType([*event_schema(strict=False, extra=extra).fields, time])


SILVER_SCHEMA = silver_schema()
GOLD_SCHEMA = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("page_views", T.LongType()),
        T.StructField("cart_adds", T.LongType()),
        T.StructField("purchases", T.LongType()),
        T.StructField("revenue", T.DoubleType()),
    ]
)
# The instant whose UTC date partitions a layer.
CLOCKS = {"bronze": "kafka_timestamp", "silver": "event_time", "gold": "window_start"}


@dataclass(frozen=True)
class Layout:
    """Directories of one deployment: a table and a checkpoint per layer under one base."""

    base: str

    def table(self, layer: str) -> str:
        return f"{self.base}/tables/{layer}"

    def checkpoint(self, layer: str) -> str:
        return f"{self.base}/checkpoints/{layer}"

    def compacted(self, layer: str) -> str:
        return f"{self.base}/compacted/{layer}"


def dated(rows: DataFrame, clock: str) -> DataFrame:
    """Rows with the partition date of their clock; null where they have no time."""
    return rows.withColumn(DATE, utc_date(F.col(clock)))


def with_date(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(DATE, T.DateType())])


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    merge_schema: bool = False,
) -> DataFrame:
    """Whole table. ``merge_schema``: without a schema given, take the columns of all files, not
    of one; older rows read as null. That opens every file, so pass the schema where known."""
    reader = spark.read.format(fmt)
    if fmt != "delta" and schema is not None:
        reader = reader.schema(schema)
    elif fmt == "parquet" and merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def read_layer(
    spark: SparkSession,
    layout: Layout,
    layer: str,
    schema: T.StructType,
    since: datetime | None = None,
    until: datetime | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Bronze or silver, whole or with ``since <= clock < until``; other dates are not read.
    Dates of silver that were compacted are read from their compacted files."""
    rows = read_table(spark, layout.table(layer), with_date(schema), fmt)
    if fmt == "parquet" and layer == "silver":
        marks = silver_marks(spark, layout)
        if marks:
            done = F.lit(marks[-1]["last"])
            rest = rows.where((F.col(DATE) > done) | F.col(DATE).isNull())
            rows = _compacted(spark, layout, marks, schema).unionByName(rest)
    return in_range(rows, CLOCKS[layer], since, until).select(schema.fieldNames())


SILVER_MARKS = T.StructType(
    [
        T.StructField("first", T.DateType()),
        T.StructField("last", T.DateType()),
        T.StructField("run", T.StringType()),
        T.StructField("dates", T.LongType()),
        T.StructField("files_before", T.LongType()),
        T.StructField("bytes_before", T.LongType()),
        T.StructField("files_after", T.LongType()),
        T.StructField("bytes_after", T.LongType()),
    ]
)


def silver_marks(spark: SparkSession, layout: Layout) -> list[Row]:
    """Complete compaction runs in the order of their dates: the dates ``(first, last]`` each
    holds (no first: all before) and the files and bytes it read and wrote. Of two runs that began
    at the same date, as compactions at once do, the longer one counts."""
    rows = read_if_there(spark, f"{layout.compacted('silver')}/marks", SILVER_MARKS).collect()
    chain: list[Row] = []
    while True:
        at = chain[-1]["last"] if chain else None
        following = [row for row in rows if row["first"] == at]
        if not following:
            return chain
        chain.append(max(following, key=lambda row: (row["last"], row["run"])))


def _compacted(
    spark: SparkSession, layout: Layout, marks: list[Row], schema: T.StructType
) -> DataFrame:
    base = f"{layout.compacted('silver')}/runs"
    stored = T.StructType([*with_date(schema).fields, T.StructField("run", T.StringType())])
    paths = [f"{base}/run={mark['run']}" for mark in marks]
    rows = spark.read.schema(stored).option("basePath", base).parquet(*paths)
    return rows.drop("run")


def compact_silver(
    spark: SparkSession,
    layout: Layout,
    cluster_by: tuple[str, ...] = ("session_id", "event_time"),
    file_bytes: int = 256 * 1024 * 1024,
    delay_days: int = 1,
    extra: list[T.StructField] | None = None,
) -> int:
    """Rewrite the closed dates of silver as sorted files of about ``file_bytes``, beside the
    stream that writes it; returns how many dates. ``silver_marks`` tells files and bytes.
    ``extra``: fields the contract has gained, as for the stream.

    Silver takes no rows behind its watermark, so a date is closed once the newest row is
    ``delay_days`` whole days past it (give more than the watermark's delay). A run is written
    under a name of its own and read only once its marker, one file written last, is there: one
    that is stopped half-way is not read, and its dates are done by the next. The stream's own
    files are not touched, so neither it nor its readers notice.
    """
    marks = silver_marks(spark, layout)
    done = marks[-1]["last"] if marks else None
    schema = with_date(silver_schema(extra))
    rows = read_table(spark, layout.table("silver"), schema)
    closed = F.date_sub(utc_date(F.max("event_time")), delay_days + 1).alias("closed")
    last = rows.agg(closed).first()["closed"]
    if last is None or (done is not None and last <= done):
        return 0
    rows = rows.where(F.col(DATE) <= F.lit(last))
    if done is not None:
        rows = rows.where(F.col(DATE) > F.lit(done))
    dates = rows.select(DATE).distinct().count()
    if dates:
        files_before, bytes_before = stored_size(rows)
        run = uuid.uuid4().hex
        path = f"{layout.compacted('silver')}/runs/run={run}"
        files = max(dates, -(-bytes_before // file_bytes))
        cluster(rows, [DATE, *cluster_by], files).write.partitionBy(DATE).parquet(path)
        after = stored_size(spark.read.schema(schema).parquet(path))
        _mark(spark, layout, (done, last, run, dates, files_before, bytes_before, *after))
    return dates


def _mark(spark: SparkSession, layout: Layout, mark: tuple) -> None:
    row = spark.createDataFrame([mark], SILVER_MARKS).coalesce(1)
    row.write.mode("append").parquet(f"{layout.compacted('silver')}/marks")


def stream_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
) -> DataFrame:
    """Table another query appends to, as a stream of its new rows. Only files that query has
    committed are seen. ``max_file_age``: as for record files."""
    reader = spark.readStream.format(fmt)
    if fmt != "delta":
        reader = reader.schema(schema).option("maxFileAge", max_file_age)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def replace_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("overwrite").save(path)


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """Make a table directory queryable by name, its partitions included. The data stays where
    it is. A name that is taken is given anew only if it stands for the same directory: dropping
    anything else might drop data. For layers and snapshots use ``registered`` or ``publish``."""
    if spark.catalog.tableExists(name):
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
        detail = {row["col_name"]: row["data_type"] for row in described}
        same = detail.get("Location") == qualified(spark, path)
        if detail.get("Type") != "EXTERNAL" or not same:
            raise ValueError(f"{name} is there already and is not an external table at {path}")
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=path, source=fmt)
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)


def publish(spark: SparkSession, name: str, query: str) -> None:
    """Make a query over stored files a view of the catalogue. It outlives the session as far as
    the catalogue does, and giving it anew is one step: who reads it sees the old one or the new.
    A table of that name is refused."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        raise ValueError(f"{name} is a table, not a view")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


@contextmanager
def registered(spark: SparkSession, **tables: DataFrame) -> Iterator[None]:
    """Tables as temporary views for SQL, a pinned snapshot among them, dropped at the end."""
    for name, rows in tables.items():
        rows.createOrReplaceTempView(name)
    try:
        yield
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)
