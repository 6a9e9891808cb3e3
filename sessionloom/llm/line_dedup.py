"""Line dedup by site-relative frequency.

A line is boilerplate of a host if more than ``max_ratio`` of the host's pages contain it, and
``min_with`` pages at least; it is then dropped wherever it stands on that host. The floor is on
the evidence, the same for hosts of any size. Lines are compared after cutting white space off
both ends; blank lines are never boilerplate.

Equal texts of one host are one page wherever pages are counted: what a page shares with its own
copies alone is no boilerplate, so where copies are still to be removed, the one to be kept keeps
its text. Texts are told apart by 128 bits.

Defined results: a null text stays null, and all null texts of a host are one page without
lines; a null host is a host of its own; repeated rows are copies; an empty table gives an empty
table. Input columns may have any names: a row travels as one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.common import SPACES, stored

MAX_RATIO = 0.1
MIN_WITH = 3
# Boilerplate of all hosts together up to which the list is broadcast; beyond, it is joined.
BROADCAST_BYTES = 8 << 20
SALTS = 32


def _trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(SPACES))


def _line_key(line: Column) -> Column:
    # 128 bits tell lines apart: two 64-bit hashes.
    bare = _trimmed(line)
    key = F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit(1), bare).alias("b"))
    return F.when(bare != "", key)


def _text_key(text: Column) -> Column:
    body = text.cast("string")
    return F.struct(F.xxhash64(body).alias("a"), F.xxhash64(F.lit(1), body).alias("b"))


def _lines(docs: DataFrame, host: str, text: str) -> DataFrame:
    return docs.select(
        F.struct("*").alias("row"),
        _text_key(F.col(text)).alias("text_key"),
        F.col(host).cast("string").alias("host"),
        F.split(F.col(text).cast("string"), "\n", -1).alias("lines"),
    ).withColumn("keys", F.transform("lines", _line_key))


def boilerplate(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    max_ratio: float = MAX_RATIO,
    min_with: int = MIN_WITH,
) -> DataFrame:
    """(host, line_key, pages_with, pages) of every boilerplate line.

    At most mean lines per page / ``max_ratio`` rows per host: each takes up more than
    ``max_ratio`` of the host's pages.
    """
    lines = _lines(docs, host, text)
    # Combined before the shuffle, so a text with very many copies is no hot key.
    owners = lines.select("host", "text_key").distinct()
    pages = owners.groupBy("host").agg(F.count("*").alias("pages"))
    once = lines.select("host", "text_key", "keys").dropDuplicates(["host", "text_key"])
    counts = (
        once.select("host", F.explode(F.array_distinct("keys")).alias("line_key"))
        .where(F.col("line_key").isNotNull())
        .groupBy("host", "line_key")
        .agg(F.count("*").alias("pages_with"))
        .where(F.col("pages_with") >= min_with)
    )
    return (
        counts.alias("c")
        # One row per host, tiny beside the lines; Spark picks the side to send.
        .join(pages.alias("p"), F.col("c.host").eqNullSafe(F.col("p.host")))
        .where(F.col("pages_with") > F.lit(max_ratio) * F.col("pages"))
        .select("c.host", "line_key", "pages_with", "pages")
    )


def drop_boilerplate(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    max_ratio: float = MAX_RATIO,
    min_with: int = MIN_WITH,
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """(row struct of the input row, n_lines, n_removed, clean_text).

    The boilerplate of a host is one row. All of it together is measured: up to
    ``broadcast_bytes`` it is broadcast and the texts stay where they are, beyond they are
    joined by host with the rows of a host dealt over ``salts`` tasks.
    """
    per_host = stored(
        boilerplate(docs, host, text, max_ratio, min_with)
        .groupBy("host")
        .agg(F.collect_list("line_key").alias("drop")),
        "boilerplate",
    )
    size = per_host.agg(
        F.sum(F.size("drop") * 16 + F.coalesce(F.octet_length("host"), F.lit(0)))
    ).first()[0]
    lines = _lines(docs, host, text).withColumn(
        "salt", F.pmod(F.xxhash64("lines"), F.lit(salts)).cast("int")
    )
    if (size or 0) <= broadcast_bytes:
        right = F.broadcast(per_host.withColumnRenamed("host", "drop_host"))
        joined = lines.join(right, F.col("host").eqNullSafe(F.col("drop_host")), "left")
    else:
        right = per_host.select(
            F.col("host").alias("drop_host"),
            "drop",
            F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("drop_salt"),
        )
        joined = lines.join(
            right,
            F.col("host").eqNullSafe(F.col("drop_host")) & (F.col("salt") == F.col("drop_salt")),
            "left",
        )
    kept = F.when(F.col("drop").isNull(), F.col("lines")).otherwise(
        F.expr("filter(lines, (l, i) -> keys[i] is null or not array_contains(drop, keys[i]))")
    )
    return joined.select("row", "lines", kept.alias("kept")).select(
        "row",
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)).cast("long").alias("n_removed"),
        F.array_join("kept", "\n").alias("clean_text"),
    )
