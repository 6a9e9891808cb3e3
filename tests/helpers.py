import json
from datetime import datetime, timedelta, timezone

from sessionloom.sources.broker import BROKER_SCHEMA, stream_record_files
from sessionloom.sources.tables import SILVER_SCHEMA

T0 = 1_704_067_200  # 2024-01-01 00:00:00 UTC, a multiple of 300 s


def at(seconds):
    """Instant this many seconds after T0."""
    return datetime.fromtimestamp(T0, timezone.utc) + timedelta(microseconds=round(seconds * 1e6))


def naive(seconds):
    return at(seconds).replace(tzinfo=None)


def event(seconds=0, **changes):
    full = {
        "event_id": "e1",
        "user_id": "user_1",
        "session_id": "s1",
        "event_type": "page_view",
        "product_id": "prod_1",
        "price": 9.5,
        "timestamp": None if seconds is None else T0 + seconds,
    }
    return {**full, **changes}


def record(value, partition=0, offset=0, seconds=0):
    """Broker record around a JSON text or an event."""
    text = value if value is None or isinstance(value, str) else json.dumps(value)
    body = None if text is None else bytearray(text.encode())
    return (bytearray(b"s1"), body, "t", partition, offset, at(seconds), 0)


def records(spark, *values):
    rows = [record(v, 0, i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, BROKER_SCHEMA)


def silver_row(seconds, session="s1", kind="page_view", price=1.0, id="e1", user="user_1"):
    when = None if seconds is None else at(seconds)
    stamp = None if seconds is None else float(T0 + seconds)
    return (id, user, session, kind, "prod_1", float(price), stamp, when)


def silver(spark, *rows):
    return spark.createDataFrame(list(rows), SILVER_SCHEMA)


def land(df, path):
    """One file, so one micro-batch when files are taken one at a time."""
    df.coalesce(1).write.mode("append").parquet(path)


def stream_of(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def stream_records(spark, path):
    return stream_record_files(spark, path, max_files_per_trigger=1)


def collect_batches(df, checkpoint):
    """Run a stream over what is there; the rows of each micro-batch that emitted any."""
    batches = []

    def keep(batch, _):
        rows = [tuple(r) for r in batch.collect()]
        if rows:
            batches.append(sorted(rows, key=repr))

    (
        df.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(keep)
        .start()
        .awaitTermination()
    )
    return batches


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
