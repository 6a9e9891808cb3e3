"""Directories of tables, on whatever file system their path names."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _opened(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def qualified(spark: SparkSession, path: str) -> str:
    """A path with the file system it is on, as the catalogue notes it."""
    system, place = _opened(spark, path)
    return system.makeQualified(place).toString()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a directory; none if it does not exist. For directories of bounded width."""
    system, place = _opened(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def numbered(spark: SparkSession, path: str, part: str) -> list[int]:
    """Numbers n of the directories ``part=n`` in one."""
    begin = f"{part}="
    names = [n for n in children(spark, path) if n.startswith(begin)]
    return sorted(int(n.removeprefix(begin)) for n in names if n.removeprefix(begin).isdigit())


def remove(spark: SparkSession, path: str) -> None:
    system, place = _opened(spark, path)
    system.delete(place, True)


def read_if_there(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet directory that may not have been written yet; reading makes nothing."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def stored_size(table: DataFrame) -> tuple[int, int]:
    """(files, bytes) a table is read from; reads no column."""
    per_file = table.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path")
    sizes = per_file.agg(F.max("file_size").alias("bytes"))
    row = sizes.agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes")).first()
    return row["files"], row["bytes"] or 0
