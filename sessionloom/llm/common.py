"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import pickle
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import sessionloom
from sessionloom.session import scratch_dir

# The white space that ends a word: space, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: it is computed once, and later
    jobs survive the loss of any executor."""
    path = f"{scratch_dir(df.sparkSession, name)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """The same for rows of several MB, which columnar files are not made for: a checkpoint in
    the shared folder."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(scratch_dir(df.sparkSession, "checkpoint"))
    return df.checkpoint()


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_bytes(df: DataFrame, column: str) -> int:
    """UTF-8 bytes of all texts."""
    total = df.agg(F.sum(F.octet_length(F.col(column).cast("string")))).first()[0]
    return int(total or 0)


def packed(value: object) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(value, protocol=5))


def unpacked(data: bytes) -> object:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def release() -> None:
    """Hand memory that a task has freed back to the system: Python workers wait between tasks,
    and what they hold on to is missing elsewhere on the executor."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def releasing(run: Callable) -> Callable:
    """Function for ``mapInArrow`` that gives memory back when it is through."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):
    # Other C libraries have no such call.
    _trim = None

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make the package importable on the executors, once per application, as ``--py-files``
    would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(sessionloom.__file__).parent
    # The driver's staging file, which Spark serves to the executors while the session lives.
    archive = Path(tempfile.mkdtemp(prefix="ship-"), "sessionloom.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, str(source.relative_to(root.parent)))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
