"""Versioned table on Delta, read like a ``BatchTable``.

Needs the Delta package on the session's classpath (``build_session(packages=[...])``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class DeltaTableStore:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark = spark
        self.path = path
        self.schema = schema

    def create(self) -> DeltaTableStore:
        empty = self.spark.createDataFrame([], self.schema)
        empty.write.format("delta").mode("ignore").save(self.path)
        return self

    def append(self, df: DataFrame, writer: str | None = None, batch_id: int | None = None) -> int:
        return self._write(df, "append", writer, batch_id)

    def replace(self, df: DataFrame, writer: str | None = None, batch_id: int | None = None) -> int:
        return self._write(df, "overwrite", writer, batch_id)

    def batch_writer(self, writer: str) -> Callable[[DataFrame, int], None]:
        def write(df: DataFrame, batch_id: int) -> None:
            self.append(df, writer, batch_id)

        return write

    def _write(self, df: DataFrame, mode: str, writer: str | None, batch_id: int | None) -> int:
        out = df.write.format("delta").mode(mode)
        if writer is not None and batch_id is not None:
            # Delta itself skips a batch it has already committed for this writer.
            out = out.option("txnAppId", writer).option("txnVersion", batch_id)
        out.save(self.path)
        return self.latest_version()

    def merge(
        self,
        updates: DataFrame,
        keys: list[str],
        changes: Mapping[str, str] | None = None,
        only_if: str | None = None,
    ) -> None:
        """Upsert by key: unknown rows are added; known ones are replaced, or changed by
        ``changes`` (column -> SQL over ``t``, the row there, and ``u``, the update), where
        ``only_if`` holds."""
        updates.createOrReplaceTempView("_upsert_updates")
        on = " AND ".join(f"t.{k} = u.{k}" for k in keys)
        guard = f" AND {only_if}" if only_if else ""
        update = ", ".join(f"t.{c} = {sql}" for c, sql in changes.items()) if changes else "*"
        updates.sparkSession.sql(
            f"MERGE INTO delta.`{self.path}` t USING _upsert_updates u ON {on} "
            f"WHEN MATCHED{guard} THEN UPDATE SET {update} WHEN NOT MATCHED THEN INSERT *"
        )

    def history(self) -> DataFrame:
        return self.spark.sql(f"DESCRIBE HISTORY delta.`{self.path}`")

    def latest_version(self) -> int | None:
        return self.history().agg(F.max("version").alias("version")).first()["version"]

    def snapshot(self, version: int | None = None) -> DataFrame:
        reader = self.spark.read.format("delta")
        if version is not None:
            reader = reader.option("versionAsOf", version)
        return reader.load(self.path)

    def compact(self, cluster_by: list[str], files: int | None = None) -> int:
        """Fewer, clustered files; Delta chooses their number."""
        self.spark.sql(f"OPTIMIZE delta.`{self.path}` ZORDER BY ({', '.join(cluster_by)})")
        return self.latest_version()
