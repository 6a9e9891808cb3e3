"""Session settings the library is tuned for, and where scratch data may go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

from sessionloom.sources.files import remove

# What a stateful query is started under.
STATE_DEFAULTS = {
    # Keyed state (one entry per event id) outgrows the heap; keep it in RocksDB.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting state rows costs a lookup per write; progress then reports none.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # Session windows: merge a partition's own sessions before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

# Left to the caller on purpose: master, memory, spark.sql.shuffle.partitions.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    **STATE_DEFAULTS,
}


def build_session(
    app_name: str,
    packages: list[str] | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """Session with the library's defaults; ``packages`` are Maven coordinates
    (the Kafka connector, Delta) and ``conf`` overrides anything."""
    builder = SparkSession.builder.appName(app_name)
    settings = {**DEFAULTS, **(conf or {})}
    if packages:
        settings["spark.jars.packages"] = ",".join(packages)
    if any("delta-spark" in p for p in packages or []):
        settings.setdefault("spark.sql.extensions", "io.delta.sql.DeltaSparkSessionExtension")
        settings.setdefault(
            "spark.sql.catalog.spark_catalog",
            "org.apache.spark.sql.delta.catalog.DeltaCatalog",
        )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Directories made inside blocks of ``scratch_scope``, innermost last.
_scopes: list[list[str]] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory for tables and checkpoints of one run.

    On a cluster this lies in the shared folder named by ``spark.checkpoint.dir``. Only a
    local session, whose driver and executors share one disk, may fall back to a temp folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    elif spark.sparkContext.master.startswith("local["):
        path = tempfile.mkdtemp(prefix=f"{name}-")
    else:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    for made in _scopes:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end of the block, the scratch directories made inside it. Results are read
    from them when they are asked for: write what is to stay before the block ends."""
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for path in made:
            remove(spark, path)


@contextmanager
def conf_overrides(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Set runtime settings for the duration of a block. A streaming query keeps the
    settings it was started under, so wrapping its start is enough."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
