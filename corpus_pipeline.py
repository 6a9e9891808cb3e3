"""Training-data pipeline: documents in, packed pieces out.

Each stage takes what its predecessor kept, written as Parquet and read again, and returns the
columns of documents; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.llm import (
    decontaminate,
    line_dedup,
    near_dedup,
    packing,
    quality_rules,
)
from sessionloom.llm.common import ship, stored, table
from sessionloom.llm.queries import tokenizer_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break neither a base rule nor a certified threshold."""
    ship(spark)
    found = quality_rules.judged(docs, table(spark, sf_dir, "labels"), keep_rows=True)
    return found.where("kept").select("row.*")


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many pages of their source share; every document
    stays, with ``n_chars`` of its new text. Copies are still in: they count as one page, or
    the lines of a text with many copies would be dropped from all of them."""
    ship(spark)
    cleaned = line_dedup.drop_boilerplate(docs)
    changed = {
        "text": F.col("clean_text"),
        "n_chars": F.length("clean_text").cast("long"),
    }
    return cleaned.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id. Rows equal in id
    and text are one document; rows without an id all stay."""
    ship(spark)
    found = near_dedup.near_duplicates(docs)
    kept = found.where("kept and doc_id is not null").select("doc_id").distinct().hint("merge")
    body = F.col("text")
    named = docs.select(
        F.struct("*").alias("row"),
        "doc_id",
        F.xxhash64(body).alias("text_a"),
        F.xxhash64(F.lit(1), body).alias("text_b"),
    )
    one = named.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text_a", "text_b"])
    return one.select("row.*").union(docs.where("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    ship(spark)
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"))
    return found.where("n_hit = 0").select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids placed in sequences."""
    ship(spark)
    return packing.pack(docs, tokenizer_path()).drop("ids")


STAGES = [
    ("quality_rules", keep_good),
    ("line_dedup", drop_boilerplate),
    ("near_dedup", one_of_each),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Token ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
